"""Source divergence, byte-level BPE and the filter audit against brute force, the public library and SQL."""

import base64
import hashlib
import os
import random
import re
from collections import Counter
from heapq import heappop
from itertools import permutations

import duckdb
import numpy as np
import public_tokenizers
import pytest
import tiktoken

from tablekin.llm import byte_bpe, filter_audit, queries, source_divergence

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, part string, n long, digest string, ids string"
VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
TWIN = "/root/testdata/sf0.01"


def frame(spark, rows):
    """Documents with extra columns whose names the operators use inside."""
    return spark.createDataFrame([(*r, 0, "x", 7, "y", "z") for r in rows], SCHEMA)


def odd_rows():
    long = " ".join(f"w{k % 97} Äpfel{'' if k % 2 else 'X'}" for k in range(20_000))
    return [
        (1, "the quick brown fox $5", "en", "a"),
        (2, None, None, None),
        (3, "", "en", "b"),
        (4, " \t\n", "de", "b"),
        (5, long, "de", "a"),
        (5, long, "de", "a"),
        (6, long, "de", None),
        (None, long, "en", None),
        (7, "THE QUICK", "en", "a"),
        (8, "the quick brown fox $5", "en", "a"),
        (9, "x" * 50_000, "fr", "c"),
        (10, "a a a a b", "", ""),
    ]


# ---- byte-level BPE -----------------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    with open(VOCABULARY, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def little(ids):
    return np.array(ids, dtype="<u4").tobytes()


def strange_texts():
    draw = random.Random(3)
    letters = "ab 'sS\t\n  éßЖ漢字🙂0٣½\x1c\x85<|endoftext|>"
    texts = ["".join(draw.choices(letters, k=draw.randrange(60))) for _ in range(400)]
    # One character of every block of Unicode, also those that editions of it class differently.
    texts += ["x" + chr(c) + "1 " + chr(c) * 3 for c in range(0x21, 0x110000, 97) if not 0xD800 <= c < 0xE000]
    texts += ["a" * 30_000, "ab" * 20_000, " " * 10_000 + "end", "".join(draw.choices("abcde", k=40_000)), "漢" * 5_000]
    return texts


def test_bpe_equals_the_library(library):
    coder = byte_bpe.Coder(VOCABULARY, PATTERN)
    for text, ids in zip(strange_texts(), coder.encode_all(strange_texts()), strict=True):
        assert ids == little(library.encode_ordinary(text)), text[:50]
        assert coder.decode(ids) == text.encode("utf-8")


def test_bpe_reads_long_texts_by_iteration(library, monkeypatch):
    monkeypatch.setattr(byte_bpe, "LIST_CHARS", 10)
    monkeypatch.setattr(byte_bpe, "LIST_PIECES", 3)
    monkeypatch.setattr(byte_bpe, "CACHE_PIECES", 4)
    coder = byte_bpe.Coder(VOCABULARY, PATTERN)
    texts = ["onely twohy threeish fourthy fivesome sixly sevenlike " * 20, "a", "", "x" * 9000, "b c dly", "ely"]
    assert list(coder.encode_all(texts)) == [little(library.encode_ordinary(t)) for t in texts]
    assert len(coder) <= 4 and "x" * 9000 not in coder


def pop(queue):
    rank = queue.lowest()
    position = heappop(queue.buckets[rank])
    if not queue.buckets[rank]:
        queue.close(rank)
    return rank, position


def test_rank_queue_gives_the_least():
    draw = random.Random(1)
    queue, plain = byte_bpe.RankQueue(300_000), []
    for _ in range(5_000):
        if plain and draw.random() < 0.45:
            plain.sort()
            assert pop(queue) == plain.pop(0)
        else:
            plain.append((draw.randrange(300_000) if draw.random() < 0.5 else draw.randrange(5), draw.randrange(10**6)))
            queue.push(*plain[-1])
    plain.sort()
    assert [pop(queue) for _ in plain] == plain and queue.lowest() == -1 and not queue.buckets


def test_bpe_rows(spark, library, monkeypatch):
    rows = odd_rows()
    encoded = byte_bpe.encode_texts(frame(spark, rows), VOCABULARY, PATTERN)
    decoded = byte_bpe.decode_ids(encoded, VOCABULARY, PATTERN)
    got = sorted((r.doc_id or -1, r.n_tokens, bytes(r.ids), bytes(r.decoded)) for r in decoded.collect())
    want = []
    for key, text, *_ in rows:
        ids = library.encode_ordinary(text or "")
        want.append((key or -1, len(ids), little(ids), (text or "").encode("utf-8")))
    assert got == sorted(want)
    assert byte_bpe.encode_texts(frame(spark, rows).limit(0), VOCABULARY, PATTERN).count() == 0


def test_bpe_query(spark, library):
    got = {r.doc_id: r for r in queries.op12_byte_bpe(spark, TWIN).collect()}
    docs = spark.read.parquet(f"{TWIN}/documents.parquet").collect()
    assert len(got) == len(docs)
    for d in docs:
        ids, r = library.encode_ordinary(d.text or ""), got[d.doc_id]
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(little(ids)).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256((d.text or "").encode("utf-8")).hexdigest()


# ---- source divergence --------------------------------------------------------------


def divergence(rows, least, top):
    """The report by plain loops."""
    groups, docs, counts = set(), Counter(), {}
    for _, text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        found = Counter(re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", low))
        counts.setdefault((lang, source), Counter()).update(found)
        for term in found:
            docs[lang, term] += 1
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for (of, t), n in docs.items() if of == lang and n >= least]
        sources = sorted(s for of, s in groups if of == lang)

        def shares(count, kept=kept):
            total = sum(count[t] for t in kept)
            return {t: 1 + 10**9 * (count[t] + 5) // (total + 5 * len(kept)) for t in kept}

        every = Counter()
        for s in sources:
            every.update(counts[lang, s])
        q, p = shares(every), {s: shares(counts[lang, s]) for s in sources}
        for s in sources:
            pairs = [(-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode()) for o in sources if o != s]
            terms = [(q[t] - p[s][t], t.encode()) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, items in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
                out += [(lang, s, part, item.decode(), -value, k + 1) for k, (value, item) in enumerate(items)]
    return sorted(out)


def corpus(seed=0):
    draw = random.Random(seed)
    vocabulary = [f"{w}{x}" for w in ("ant", "Bee", "cät", "ñu", "漢") for x in "abcdefghijkl"]
    rows = []
    for k in range(240):
        lang, source = draw.choice(["en", "de", None]), draw.choice(["s1", "s1", "s1", "s2", "s3", "é", None])
        rows.append((k, " ".join(draw.choices(vocabulary[: 20 + 40 * (source == "s2")], k=draw.randrange(25))), lang, source))
    return rows


@pytest.mark.parametrize("options", [{}, {"digest_bits": 3}, {"digest_bits": 1, "block_terms": 2, "tile_sources": 2}, {"block_terms": 5, "tile_sources": 1}])
def test_divergence(spark, options):
    rows = corpus()
    found = source_divergence.source_divergence(frame(spark, rows), min_documents=6, top_terms=7, **options)
    assert sorted(map(tuple, found.collect())) == divergence(rows, 6, 7)


@pytest.mark.parametrize("bits", [64, 2])
def test_divergence_of_odd_rows(spark, bits):
    found = source_divergence.source_divergence(frame(spark, odd_rows()), 2, 3, digest_bits=bits)
    assert sorted(map(tuple, found.collect())) == divergence(odd_rows(), 2, 3)
    high = source_divergence.source_divergence(frame(spark, odd_rows()), 100, 3)
    assert sorted(map(tuple, high.collect())) == divergence(odd_rows(), 100, 3)
    assert source_divergence.source_divergence(frame(spark, odd_rows()).limit(0)).count() == 0


def test_long_texts_are_cut_between_terms(monkeypatch):
    text = ("Äpfel1birne zzz " * 40 + "x" * 100 + " y").encode("utf-8")
    whole = [t for part in source_divergence._terms(text) for t in part]
    for size in (1, 3, 7, 50, 1000):
        monkeypatch.setattr(source_divergence, "PIECE_BYTES", size)
        assert [t for part in source_divergence._terms(text) for t in part] == whole


# ---- filter audit -------------------------------------------------------------------


def audit(rows, labels):
    """The audit by walking every document through every order."""
    good, toxic = {k for k, q, _ in labels if q == 1}, {k for k, _, t in labels if t == 1}
    first = {}
    for key, text, *_ in rows:
        if key is not None:
            first[text or ""] = min(key, first.get(text or "", key))
    docs = []
    for key, text, _, source in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {
            "A": len(words) < 200,
            "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 2 * len(text),
            "D": bool(re.search("[#$%&*|]", text)),
            "E": key is not None and key > first[text],
        }
        known = key is not None
        docs.append((source or "", {k for k, v in fails.items() if v}, known and key in good, known and key in toxic))
    out = {}
    for part in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == part]
        shapley = Counter()
        for order in permutations("ABCDE"):
            left = mine
            for step, f in enumerate(order):
                gone = [d for d in left if f in d[1]]
                left = [d for d in left if f not in d[1]]
                failing = sum(f in d[1] for d in mine)
                alone = sum(d[1] == {f} for d in mine)
                shapley[f] += len(gone)
                lost = (sum(d[2] for d in gone), sum(d[3] for d in gone))
                out[part, "".join(order), step + 1] = [len(left), len(gone), failing - len(gone), alone, *lost, f]
        for key, row in out.items():
            if key[0] == part:
                row[-1] = shapley[row[-1]]
    return sorted((*key, *row) for key, row in out.items())


def audit_rows():
    draw = random.Random(5)
    texts = []
    for _ in range(40):
        words = [f"w{draw.randrange(draw.choice([5, 400]))}" for _ in range(draw.choice([20, 199, 200, 260]))]
        if draw.random() < 0.4:
            words += [draw.choice("#$%&*|")]
        if draw.random() < 0.4:
            words += ["CAPITALS"] * draw.randrange(6)
        texts.append(" ".join(words))
    rows = [(k, draw.choice(texts), "en", draw.choice(["a", "b", "", None])) for k in range(150)]
    return rows + [(None, texts[0], "en", "a"), (None, texts[0], "en", "a"), *odd_rows(), (2, texts[1], "en", "b")]


def test_audit(spark, monkeypatch):
    monkeypatch.setattr(filter_audit, "PARTS_AT_ONCE", 2)
    rows = audit_rows()
    labels = [(k, k % 3 % 2, k % 4 // 3) for k in range(0, 150, 2)] + [(4, 1, 1), (4, None, None), (None, 1, 1), (9999, 1, 1)]
    marks = spark.createDataFrame([(*r, "q", 1) for r in labels], "doc_id long, quality int, toxic int, part string, digest int")
    found = filter_audit.filter_audit(frame(spark, rows), marks)
    assert sorted(map(tuple, found.collect())) == audit(rows, labels)
    bare = filter_audit.filter_audit(frame(spark, rows), marks.limit(0))
    assert sorted(map(tuple, bare.collect())) == audit(rows, [])
    assert filter_audit.filter_audit(frame(spark, rows).limit(0), marks).count() == 0


@pytest.mark.parametrize("name", ["op11_source_divergence", "op13_filter_audit"])
def test_twin(spark, name):
    con = duckdb.connect()
    for table in ("documents", "labels"):
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{os.path.join(TWIN, table)}.parquet'")
    found = queries.QUERIES[name](spark, TWIN)
    twin = con.sql(queries.oracles()[name])
    assert sorted(twin.columns) == sorted(found.columns)
    assert sorted(map(tuple, found.select(*twin.columns).collect())) == sorted(twin.fetchall())
