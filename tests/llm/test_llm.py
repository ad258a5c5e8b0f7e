"""Edge cases and brute-force comparisons of the training-data operators on small frames."""

import math
import os
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tablekin.llm import (
    components,
    decontaminate,
    hidden_markov,
    language_id,
    license_scan,
    mixing,
    ngram_join,
    permutation_index,
    surrogates,
    token_binary,
    toxicity,
)
from tablekin.llm.components import connected_components

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row long, token string, leader string, n long"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def frame(spark, rows):
    """Documents with extra columns whose names operators use inside."""
    full = [(*r, 0, 1, "x", "y", 7) for r in rows]
    return spark.createDataFrame(full, SCHEMA)


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def words(text):
    return WORDS.findall(lower(text))


def odd_rows():
    long = " ".join(f"w{k % 997}" for k in range(30_000))
    return [
        (1, "the quick brown fox jumps over the lazy dog", "en", "a"),
        (2, None, None, None),
        (3, "", "en", "b"),
        (4, " \t\n", "de", "b"),
        (5, long, "de", "a"),
        (5, long, "de", "a"),
        (6, "The Quick brown fox jumps over the lazy dog", None, "c"),
        (None, "no id at all here today", "en", None),
        (8, "12 34 ... !!", "fr", "a"),
        (9, "x" * 5000, "fr", "c"),
    ]


@pytest.fixture(scope="module")
def odd(spark):
    return frame(spark, odd_rows())


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def brute_components(rows):
    sets, parent = {}, {}
    for key, text in rows:
        w = words(text)
        sets[key] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
        parent[key] = key

    def find(k):
        while parent[k] != k:
            k = parent[k]
        return k

    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            shared = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * shared >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {k: (len(sets[k]), find(k)) for k in keys}


def test_ngram_join_equals_brute_force(spark):
    rnd = random.Random(3)
    passage = [f"p{k}" for k in range(60)]
    rows = []
    for key in range(160):
        kind = key % 4
        base = [f"b{key // 40}_{k}" for k in range(80)]
        if kind == 0:  # near copies with one to four changed words: similarities on both sides of the limit
            for _ in range(rnd.randint(1, 4)):
                base[rnd.randrange(80)] = f"c{rnd.randrange(9)}"
        elif kind == 1:  # a shared passage
            base = passage[: rnd.randint(40, 60)] + [f"o{key}_{k}" for k in range(rnd.randint(0, 20))]
        elif kind == 2:
            base = [f"w{rnd.randrange(5)}" for _ in range(rnd.randint(0, 7))]
        rows.append((key, " ".join(base) + "\n", "en", "s"))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.similarity_classes(frame(spark, rows)).collect()}
    assert got == brute_components([r[:2] for r in rows])


def test_full_license_texts(spark):
    """Whole texts with changed case, punctuation, copyright lines and spellings."""
    folder = "/usr/share/common-licenses"
    if not os.path.isdir(folder):
        pytest.skip("no licence texts on this machine")
    changed = {"Apache-2.0": "Apache-2.0", "BSD": "BSD-3-Clause", "GPL-3": "GPL-3.0", "MPL-2.0": "MPL-2.0"}
    rows = []
    for key, (name, _) in enumerate(sorted(changed.items())):
        with open(os.path.join(folder, name), encoding="utf-8") as file:
            text = file.read()
        text = "Copyright (c) 2031 Some Body\n" + text.upper().replace(",", " ;").replace("LICENSE", "LICENCE")
        rows += [(key, text, "en", "s"), (100 + key, text + " and more", "en", "s")]
    known = license_scan.known_notices(spark), license_scan.known_texts(spark)
    got = {r.doc_id: r.license_id for r in license_scan.scan_licenses(frame(spark, rows), *known).collect()}
    assert [got[k] for k in range(4)] == [changed[n] for n in sorted(changed)]
    assert not any(got[100 + k] for k in range(4))


def test_licenses_of_rows_that_repeat(spark):
    mit, apache = "Released under the MIT License.", "Licensed under the Apache License, Version 2.0."
    rows = [(1, f"{mit}\n{apache}", "en", "s"), (1, f"x\n{mit}\n{mit}", "en", "s"), (1, f"x\n{mit}\n{mit}", "en", "s")]
    rows += [(None, "nothing here", "en", "s"), (None, f"a\n{mit}", "en", "s"), (None, None, "en", "s")]
    got = license_scan.scan_licenses(frame(spark, rows), license_scan.known_notices(spark)).collect()
    found = Counter((r.doc_id, r.notices, r.n_notices) for r in got)
    assert found == Counter({(1, "Apache-2.0,MIT", 2): 1, (1, "MIT", 2): 2, (None, "MIT", 1): 1, (None, "", 0): 2})


def test_numbers_are_no_letters(spark):
    rows = [(k, "the house is old and the dog is young", "en", "s") for k in range(40)]
    rows += [(40 + k, "das haus ist alt und der hund ist jung", "de", "s") for k in range(40)]
    rows += [(100, "½", None, "s"), (101, "² ³ ①", None, "s"), (102, "ª", None, "s")]
    docs = frame(spark, rows)
    found = {r.doc_id: r.lang_pred for r in language_id.predict_languages(docs, language_id.fit_languages(docs)).collect()}
    assert (found[100], found[101]) == ("und", "und") and found[102] != "und"


def test_vectors_compare_within_their_width(spark):
    rnd = random.Random(5)
    rows = [(k, [rnd.gauss(0, 1) for _ in range(8)]) for k in range(100)]
    rows += [(200, [rnd.gauss(0, 1) for _ in range(9)]), (250, [rnd.gauss(0, 1) for _ in range(3)]), (251, [1.0, 0.0, 0.0])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = permutation_index.nearest(vectors, vectors.where("vec_id % 50 = 0")).collect()
    per = Counter(r.query_id for r in got)
    assert per == Counter({0: 5, 50: 5, 250: 1})
    assert {r.vec_id for r in got if r.query_id == 250} == {251}


def test_ngram_join_tells_long_words_apart(spark):
    """Words whose letters follow the parity of the ones in their place's number cancel out in sums of powers."""
    parity = "".join("ab"[bin(k).count("1") % 2] for k in range(1024))
    swapped = parity.translate(str.maketrans("ab", "ba"))
    rows = [(1, parity, "en", "s"), (2, swapped, "en", "s"), (3, parity, "en", "s")]
    rows += [(k, f"{w} one two three four five", "en", "s") for k, w in ((4, parity), (5, swapped))]
    got = {r.doc_id: r.component_id for r in ngram_join.similarity_classes(frame(spark, rows)).collect()}
    assert got == {1: 1, 2: 2, 3: 1, 4: 4, 5: 5}


def test_ngram_join_of_rows_that_repeat(spark):
    texts = [" ".join(f"{c}{k}" for k in range(30)) for c in "abc"]
    rows = [(1, texts[0], "en", "s")] * 40 + [(2, texts[0] + " more", "en", "s")] * 40 + [(3, texts[1], "en", "s"), (3, texts[2], "en", "s")]
    got = Counter((r.doc_id, r.component_id) for r in ngram_join.similarity_classes(frame(spark, rows)).collect())
    assert got == Counter({(1, 1): 40, (2, 1): 40, (3, 3): 2})


def test_ngram_join_edge_cases(odd, none):
    rows = ngram_join.similarity_classes(odd).collect()
    assert len(rows) == 10
    by_id = {r.doc_id: r for r in rows}
    assert by_id[6].component_id == 1 and by_id[1].n_shingles == 5
    assert [by_id[k].n_shingles for k in (2, 3, 4)] == [0, 0, 0] and by_id[2].component_id == 2
    assert by_id[None].component_id is None
    assert ngram_join.similarity_classes(none).count() == 0


@pytest.mark.parametrize("changed", [3, 4])
def test_ngram_join_reports_few_pairs_of_a_family(spark, monkeypatch, changed):
    """Near copies under the limit: positions rule nearly all pairs out before they are reported."""
    rnd = random.Random(changed)
    counts = {}

    def counted(df, label, real=ngram_join.stage_table):
        staged = real(df, label)
        counts[label] = staged.count()
        return staged

    monkeypatch.setattr(ngram_join, "stage_table", counted)
    rows = []
    for key in range(400):
        base = [f"f{k}" for k in range(120)]
        for place in rnd.sample(range(120), changed):
            base[place] = f"c{key}_{place}"
        rows.append((key, " ".join(base), "en", "s"))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.similarity_classes(frame(spark, rows)).collect()}
    assert got == brute_components([r[:2] for r in rows])
    assert counts["ngram-pairs"] <= counts["ngram-met"] <= {3: 10, 4: 0.1}[changed] * len(rows)


def test_ngram_join_plans_stay_small(spark, monkeypatch):
    """Each written table has a short plan: the driver keeps every version of one that adaptive execution changes."""
    exchanges = {}

    def planned(df, label, real=ngram_join.stage_table):
        plan = df._jdf.queryExecution().executedPlan().toString()
        exchanges[label] = max(exchanges.get(label, 0), sum("Exchange" in line for line in plan.splitlines()))
        return real(df, label)

    monkeypatch.setattr(ngram_join, "stage_table", planned)
    monkeypatch.setattr(components, "stage_table", planned)
    rnd, rows = random.Random(7), []
    for key in range(60):
        base = [f"f{k}" for k in range(120)]
        for place in rnd.sample(range(120), 2):
            base[place] = f"c{key}_{place}"
        rows.append((key, " ".join(base), "en", "s"))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.similarity_classes(frame(spark, rows)).collect()}
    assert got == brute_components([r[:2] for r in rows])
    assert "ngram-near" in exchanges and max(exchanges.values()) <= 16, exchanges


def test_groups_are_written_before_one_row_of_each_is_chosen(spark):
    rows = [(key, f"w{key} " * 9, "en", "s", 1) for key in range(4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, "")
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert sum("Exchange" in line for line in plan.splitlines()) <= 6, plan
    assert sorted(r.doc_id for r in kept.collect()) == [0, 1, 2, 3]


def test_one_row_of_each_group_stays(spark):
    texts = {k: " ".join(f"{k}{j}" for j in range(40)) for k in "abcd"}
    near = texts["a"] + " more"
    rows = [(7, texts["a"], "en", "s", 1)] * 50 + [(9, near, "en", "s", 1), (None, texts["a"], "en", "s", 1)]
    rows += [(9, texts["b"], "en", "s", 1)]  # shares its id with a near copy of 7, but no text
    rows += [(None, texts["c"], "en", "s", 1)] * 20
    rows += [(3, texts["d"], "en", "s", 1), (3, texts["d"] + " more", "en", "s", 1)]
    rows += [(11, None, "en", "s", 0)] * 3 + [(12, None, "en", "s", 0), (12, "", "en", "s", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(6)
    got = corpus_pipeline.drop_near_duplicates(spark, docs, "")
    assert got.columns == corpus_pipeline.COLUMNS
    got = Counter((r.doc_id, (r.text or "-")[:2] if r.text != "" else "") for r in got.collect())
    assert got == Counter([(7, "a0"), (9, "b0"), (None, "c0"), (3, "d0"), (11, "-"), (12, "-"), (12, "")])


def test_components(spark):
    links = [(k, k + 1) for k in range(1, 40)] + [(100, 7), (200, 201), (201, 202), (202, 200)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{k: 1 for k in range(1, 41)}, 100: 1, 200: 200, 201: 200, 202: 200}


def test_licenses(spark, odd, none):
    texts = [
        (1, "released UNDER the mit licence!", "en", "a"),
        (2, "Copyright (c) 2020 Somebody\nReleased under the MIT License.\n", "en", "a"),
        (3, "words\nLicensed under CC BY-NC 4.0.\nmore words", "en", "a"),
        (4, "It is not released under the MIT License.", "en", "a"),
        (5, None, "en", "a"),
    ]
    known = license_scan.known_notices(spark)
    rows = {r.doc_id: r for r in license_scan.scan_licenses(frame(spark, texts), known).collect()}
    assert (rows[1].license_id, rows[2].license_id) == ("MIT", "MIT")
    assert (rows[3].license_id, rows[3].notices, rows[3].n_notices) == (None, "CC-BY-NC-4.0", 1)
    assert (rows[4].license_id, rows[4].notices) == (None, "") and rows[5].digest is None
    assert license_scan.scan_licenses(odd, known).count() == 10
    assert license_scan.scan_licenses(none, known).count() == 0
    assert {r.license_id for r in license_scan.scan_licenses(odd, known.where("false")).collect()} == {None}


def test_wand_finds_what_full_scoring_finds():
    rnd = random.Random(1)
    items = [(k, " ".join(f"t{int(rnd.paretovariate(1)) % 60}" for _ in range(rnd.randint(5, 50)))) for k in range(150)]
    index = decontaminate.build_index(items)
    for _ in range(200):
        terms = {index.terms[w] for w in {f"t{int(rnd.paretovariate(1)) % 60}" for _ in range(20)} if w in index.terms}
        threshold = rnd.choice([index.least, 3.0, 8.0])
        scores = defaultdict(float)
        for t in terms:
            for item, value in zip(*index.lists[t], strict=True):
                scores[int(item)] += float(value)
        full = {k for k, v in scores.items() if v >= threshold and v >= index.need[k]}
        assert {k for k, _ in decontaminate.retrieve(index, terms, threshold)} == full


def test_decontamination(spark, odd, none):
    items = [(k, " ".join(f"q{k}x{j}" for j in range(20)) + ". " + " ".join(f"a{k}x{j}" for j in range(6)) + ".") for k in range(30)]
    items += [(None, None), (99, "")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    filler = " ".join(f"f{k}" for k in range(500))
    rows = [
        (1, f"{filler} {items[3][1].upper()} {filler}", "en", "a"),
        (2, filler, "en", "a"),
        (3, " ".join(f"q5x{j}" for j in range(5)), "en", "a"),  # a quarter of a question
        (4, items[7][1] + " " + items[8][1], "en", "a"),
    ]
    docs = frame(spark, rows)
    hits = {(r.doc_id, r.item_id) for r in decontaminate.find_contaminated(docs, bench).collect()}
    assert hits == {(1, 3), (4, 7), (4, 8)}
    kept = decontaminate.keep_uncontaminated(docs, bench)
    assert {r.doc_id for r in kept.collect()} == {2, 3} and kept.columns == docs.columns
    assert decontaminate.keep_uncontaminated(odd, bench).count() == 10
    assert decontaminate.find_contaminated(none, bench).count() == 0
    assert decontaminate.find_contaminated(docs, bench.where("false")).count() == 0


def test_clause_grammar_and_toxicity(spark, odd, none):
    grammar = toxicity.clause_grammar()
    assert len(grammar.states) == 32
    seen, weight = grammar.accept([("insult", 2.0), ("target", 1.0), ("insult", 1.5)])
    assert seen == (True, False, True, False, False) and weight == 3.5
    rnd = random.Random(2)
    rows, labels = [], []
    for key in range(600):
        text = [rnd.choice("alpha beta gamma delta omega sigma lambda".split()) for _ in range(40)]
        toxic = key % 5 == 0
        if toxic:
            for _ in range(3):
                text[rnd.randrange(40)] = rnd.choice(["blorgid", "zugnoth"]) + rnd.choice(["a", "en", "os"])
        rows.append((key, " ".join(text) + ".", "en", "a"))
        labels.append((key, int(toxic)))
    labels = spark.createDataFrame([*labels, (None, 1), (3, None)], "doc_id long, toxic int")
    docs = frame(spark, rows)
    model = toxicity.fit_toxicity(docs, labels)
    got = {r.doc_id: r.score for r in toxicity.score_toxicity(docs, model).collect()}
    held = [k for k in got if zlib.crc32(str(k).encode()) % 5 == 0]
    assert held and all((got[k] >= 0.5) == (k % 5 == 0) for k in held)
    kept = toxicity.keep_clean(docs, model)
    assert {r.doc_id for r in kept.collect()} == {k for k in got if k % 5}
    assert all(0 <= r.score < 0.5 for r in toxicity.score_toxicity(odd, model).collect())
    assert toxicity.score_toxicity(none, model).count() == 0
    bare = toxicity.fit_toxicity(docs, labels.where("false"))
    assert {r.score for r in toxicity.score_toxicity(odd, bare).collect()} == {0.0}


def test_forward_and_counts_equal_enumeration():
    rng = np.random.default_rng(0)
    k, s = 3, 4
    m = hidden_markov.Markov(*(x / x.sum(axis=-1, keepdims=True) for x in (rng.random(k), rng.random(k), rng.random((k, k)), rng.random((k, s)))))
    sequences = [np.array(x, dtype=np.uint16) for x in ([0, 1, 2, 3, 1], [2], [1, 1, 0])]
    first = np.array([True, False, True])
    counts = hidden_markov.expected_counts(m, sequences, first)
    start, resume, move, emit = np.zeros(k), np.zeros(k), np.zeros((k, k)), np.zeros((k, s))
    for x, begins in zip(sequences, first, strict=True):
        paths = []
        for path in np.ndindex(*(k,) * len(x)):
            p = (m.start if begins else m.resume)[path[0]] * m.emit[path[0], x[0]]
            for t in range(1, len(x)):
                p *= m.move[path[t - 1], path[t]] * m.emit[path[t], x[t]]
            paths.append((path, p))
        total = sum(p for _, p in paths)
        if begins:
            assert math.isclose(hidden_markov.log_likelihoods(m, [x])[0], math.log10(total))
        for path, p in paths:
            (start if begins else resume)[path[0]] += p / total
            for t in range(len(x)):
                emit[path[t], x[t]] += p / total
                if t:
                    move[path[t - 1], path[t]] += p / total
    for got, want in ((counts.start, start), (counts.resume, resume), (counts.move, move), (counts.emit, emit)):
        assert np.allclose(got, want)


def test_markov_scores(odd, none):
    got = hidden_markov.score_texts(odd, F.coalesce(F.col("doc_id") != 1, F.lit(True))).collect()
    tokens = {k: words(t) + ["\n"] for k, t, *_ in odd_rows()}
    count = Counter(w for k, t, *_ in odd_rows() if k != 1 for w in words(t) + ["\n"])
    n, v = sum(count.values()), len(count)
    assert len(got) == 10
    for r in got:
        t = tokens[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(t), sum(w in count for w in t), n)
        assert math.isclose(r.base_score, sum(math.log10((count[w] + 1) / (n + v + 1)) for w in t), rel_tol=1e-9)
        assert r.score <= 0
    assert hidden_markov.score_texts(none, F.lit(True)).count() == 0
    assert hidden_markov.score_texts(odd, F.lit(False)).count() == 10


def test_mixing(spark, odd, none):
    rnd = random.Random(4)
    rows = [(k, " ".join(["w"] * rnd.randint(0, 60)), "en", rnd.choice(["a", "a", "a", "b", "c", None])) for k in range(900)]
    plan = mixing.mix_plan(frame(spark, rows)).collect()
    sizes = Counter()
    for _, t, _, s in rows:
        sizes[s] += len(words(t))
    # water filling by repeated resharing
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None]
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(order)}
    left, target, open_ = 1.5 * sum(sizes.values()), {}, set(order)
    while open_:
        share = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if share * weight[s] > 2 * sizes[s]}
        for s in full or open_:
            target[s] = 2.0 * sizes[s] if full else share * weight[s]
        left -= sum(target[s] for s in full)
        open_ = open_ - full if full else set()
    taken = Counter()
    for r in plan:
        taken[r.source] += r.taken
        assert r.taken == r.copies * r.size <= 2 * r.size and len(r.shards) == r.copies
        assert math.isclose(r.target, target[r.source]) and r.source_size == sizes[r.source]
    assert len(plan) == 900 and all(abs(taken[s] - target[s]) <= 30 for s in order)
    again = mixing.mix_plan(frame(spark, rows[::-1])).collect()
    assert {(r.doc_id, r.taken, tuple(r.shards)) for r in plan} == {(r.doc_id, r.taken, tuple(r.shards)) for r in again}
    mixed = mixing.mix_documents(frame(spark, rows))
    assert Counter(r.doc_id for r in mixed.collect()) == Counter({r.doc_id: r.copies for r in plan if r.copies})
    assert mixing.mix_plan(odd).count() == 10 and mixing.mix_plan(none).count() == 0
    assert mixing.mix_documents(none).count() == 0


def test_languages(spark, odd, none):
    rnd = random.Random(5)
    syllables = {"aa": "ka lo mi ru te".split(), "bb": "schu bren kopf tig ung".split(), "cc": "éa ñol ciò ura ês".split()}
    rows = []
    for key in range(400):
        lang = rnd.choice(list(syllables))
        text = " ".join("".join(rnd.choice(syllables[lang]) for _ in range(3)) for _ in range(30))
        rows.append((key, text, lang, "s"))
    docs = frame(spark, rows)
    model = language_id.fit_languages(docs)
    got = {r.doc_id: r.lang_pred for r in language_id.predict_languages(docs, model).collect()}
    held = [(k, lang) for k, _, lang, _ in rows if zlib.crc32(str(k).encode()) % 4 == 2]
    assert held and all(got[k] == lang for k, lang in held)
    rows = {r.doc_id: r for r in language_id.predict_languages(odd, model).collect()}
    assert [rows[k].lang_pred for k in (2, 3, 4, 8)] == ["und"] * 4 and rows[9].lang_pred in syllables
    assert all(0 <= r.score <= 1 for r in rows.values())
    assert language_id.predict_languages(none, model).count() == 0
    empty = language_id.fit_languages(none)
    assert {r.lang_pred for r in language_id.predict_languages(odd, empty).collect()} == {"und"}


def test_surrogates(spark, odd, none):
    rows = [
        (1, "mail bosbt.42@mail8.example.com or +1 (988) 555-2485 now", "en", "a"),
        (2, "4041894974608795, again bosbt.42@mail8.example.com; password=b7db7aa4", "en", "a"),
        (3, "from 42.144.35.254. Mrs Anna Schmidt and Mr Jones, 123-45-6789", "en", "a"),
        (4, "nothing here 12 3.5 1.2.3", "en", "a"),
    ]
    got = {r.doc_id: r for r in surrogates.replace_personal(frame(spark, rows)).collect()}
    assert got[1].kinds == "email,phone" and got[2].kinds == "card,email,secret" and got[4].text == rows[3][1]
    assert got[3].kinds == "address,name,name,social"
    for key, text, *_ in rows[:3]:
        for value in re.findall(surrogates.EMAIL.replace("++", "+") + r"|\d{16}|b7db7aa4|42\.144\.35\.254|Schmidt|Jones|555-2485|123-45-6789", text):
            assert value not in got[key].text
    mails = [re.search(r"\S+@\S+?\.com", got[k].text)[0] for k in (1, 2)]
    assert mails[0] == mails[1] and re.fullmatch(r"[a-z]{5}\.\d\d@[a-z]{4}\d\.[a-z]{7}\.com", mails[0])
    assert re.search(r"or \+1 \(\d{3}\) \d{3}-\d{4} now$", got[1].text) and re.match(r"4\d{15}, again", got[2].text)
    assert re.search(r"Mrs (\w+) ", got[3].text)[1] in surrogates.GIVEN["latin", "f"].split()
    values = spark.range(3000).select(F.lit("address").alias("kind"), F.concat(F.lit("10.0."), F.expr("id div 256"), F.lit("."), F.expr("id % 256")).alias("value"))
    table = surrogates.surrogate_table(values, "k").collect()
    assert len({r.stand_in for r in table}) == 3000 == len(table) and not {r.stand_in for r in table} & {r.value for r in table}
    few = spark.createDataFrame([("card", str(k)) for k in range(10)], "kind string, value string")
    assert len({r.stand_in for r in surrogates.surrogate_table(few, "k").collect()}) == 10
    kept = sorted((str(r.doc_id), r.text or "") for r in surrogates.replace_personal(odd).collect())
    assert kept == sorted((str(r[0]), r[1] or "") for r in odd_rows())
    assert surrogates.replace_personal(none).count() == 0


def test_secrets_in_every_form(spark):
    low, high = "11acdfb36bb72224148e6160f674b4be45601bff", "9233A8ECF7C5B09FE5949719B6B82BC439E9329B"
    forms = {
        "spaced": (f'ti of token = "{low}" anhaou', low, "ti of token = \"", "\" anhaou"),
        "upper": (f'A,!! TOKEN = "{high}"!! TIINST', high, 'A,!! TOKEN = "', '"!! TIINST'),
        "bare": (f"token={low}", low, "token=", ""),
        "tight": (f'### token="{low}"###', low, '### token="', '"###'),
        "single": (f"Api-Key : '{low}';", low, "Api-Key : '", "';"),
        "json": (f'{{"accessToken": "{low}", "n": 1}}', low, '{"accessToken": "', '", "n": 1}'),
        "escaped": (f'{{\\"secret\\":\\"{low}\\"}}', low, '{\\"secret\\":\\"', '\\"}'),
        "url": (f"/x?token={low}&page=2", low, "/x?token=", "&page=2"),
        "cut off": (f'token = "{low}', low, 'token = "', ""),
        "mixed": ("Password: p@ss.w0rd&Yd5.", "p@ss.w0rd&Yd5", "Password: ", "."),
        "phrase": ('passphrase = "пароль с 123"', "пароль с 123", 'passphrase = "', '"'),
    }
    plain = ["the token is here", 'token = ""', "tokens of 12", "secret: ..."]
    rows = [(k, form[0], "en", "a") for k, form in enumerate(forms.values())] + [(100 + k, t, "en", "a") for k, t in enumerate(plain)]
    got = {r.doc_id: r for r in surrogates.replace_personal(frame(spark, rows)).collect()}
    remaining, shown = Counter(), defaultdict(set)
    for k, (name, (_, value, before, after)) in enumerate(forms.items()):
        text = got[k].text
        assert got[k].kinds == "secret" and text.startswith(before) and text.endswith(after), (name, text)
        remaining[name] = text.count(value)
        shown[value].add(text[len(before) : len(text) - len(after)])
    assert not any(remaining.values()), remaining
    # One secret, one stand-in of its form, whatever stands around it.
    assert all(len(news) == 1 for news in shown.values())
    assert re.fullmatch(r"\d\d[a-z]{4}.{34}", *shown[low]) and re.fullmatch("[0-9A-Z]{40}", *shown[high])
    assert [got[100 + k].text for k in range(len(plain))] == plain


def test_no_secret_of_the_documents_remains(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    form = re.compile(r'(?i)token = "([0-9a-f]{40})"')
    held = {v for r in docs.collect() for v in form.findall(r.text or "")}
    out = surrogates.replace_personal(docs).collect()
    assert len(held) > 10 and sum(v in held for r in out for v in re.findall("(?i)[0-9a-f]{40}", r.text or "")) == 0


def test_permutation_index(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(1200, 16)).astype(np.float32)
    x[100:160] = x[100]
    rows = [(k, v.tolist(), 0) for k, v in enumerate(x)]
    rows += [(2000, None, 0), (2050, [0.0] * 16, 0), (2100, [float("nan")] * 16, 0), (2150, [1.0] * 15 + [None], 0), (None, [1.0] * 16, 0)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score int")
    got = defaultdict(dict)
    for r in permutation_index.nearest(vectors, vectors.where("vec_id % 50 = 0")).collect():
        got[r.query_id][r.rank] = (r.vec_id, r.score)
    y = x.astype(np.float64)
    norm = np.sqrt((y * y).sum(axis=1))
    found = 0
    for q in range(0, 1200, 50):
        s = (y * y[q]).sum(axis=1) / (norm * norm[q])
        s[q] = -9
        found += len(set(np.lexsort((np.arange(1200), -s))[:5].tolist()) & {v for v, _ in got[q].values()})
        assert all(abs(s[v] - score) < 1e-12 for v, score in got[q].values()) and sorted(got[q]) == [1, 2, 3, 4, 5]
    assert set(got) == set(range(0, 1200, 50)) and found >= 0.9 * 5 * 24
    assert [got[100][k][0] for k in range(1, 6)] == [101, 102, 103, 104, 105]
    few = vectors.where("vec_id < 3")
    assert permutation_index.nearest(few, few.where("vec_id = 0")).count() == 2
    assert permutation_index.nearest(vectors.where("false"), vectors).count() == 0


def test_token_files(spark, odd, none, tmp_path):
    from tokenizers import Tokenizer

    path = pytest.importorskip("public_tokenizers").path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    rows = [*odd_rows(), (7, "It's J̌ İ, ΑΣ. don't<|endoftext|>Word, word.\x1c x y", "en", "a")]
    folder = token_binary.write_token_files(frame(spark, rows), path, str(tmp_path / "t"), block_ids=40)
    got = token_binary.read_token_files(spark, folder).orderBy("start").collect()
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0))
    at = 0
    for r, (key, text, *_) in zip(got, rows, strict=True):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        assert (r.doc_id, r.start, r.n_tokens) == (key, at, len(ids))
        assert r.ids_crc32 == zlib.crc32(np.array(ids, dtype="<u4").tobytes())
        at += len(ids)
    assert token_binary.token_binary(none, path).count() == 0


def test_elias_fano():
    rng = np.random.default_rng(7)
    for n, top in ((1, 1), (5, 3), (2000, 90), (3000, 10**9), (300, 0)):
        ends = np.sort(rng.integers(0, top + 1, n))
        width, low, high, selects = token_binary.ef_encode(ends)
        read = token_binary.EliasFano(n, width, low, high, selects)
        assert (read.all() == ends).all() and all(read.select(k) == ends[k] for k in range(0, n, 7))
        assert 8 * (len(low) + len(high)) <= n * (3 + math.log2(max(2, top / n + 1))) + 16
