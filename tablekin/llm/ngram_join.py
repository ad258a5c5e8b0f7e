"""Exact Jaccard join of word n-gram sets, with set relations used to skip work.

The join answers "which documents hang together" (class ids), so a pair whose two
sides are known to be connected needs no test.

1. Equal sets fold into one class (its smallest doc_id); only classes go on.
2. Leaders.  Classes that share minimum hashes and a size band are compared with
   two of them, the most central and another one.  A class that links with a central
   one keeps this leader and its exact distance.
3. Index.  Every class posts the prefix of its set, rarest shingles first.  The
   posts of one leader's followers for one token make a block with its range of set
   sizes and its first position.  Two blocks of a list are skipped, before anything is
   reported, when links with leaders connect them already or when no pair of them can
   reach the overlap that sizes and positions allow: of the shingles that two sets
   share the first one leaves room for all others.
4. Of the remaining pairs of leaders those without followers pass a bound on the
   shingles that their prefixes share, from 16 bits per shingle; then all that are
   left are compared exactly.
5. Answers of followers derive from those of their leaders.  Jaccard distance is a
   metric, so followers x and y of leaders a and b can link only if
   d(a, b) <= limit + d(x, a) + d(y, b).  Only for such leader pairs, and only if not
   connected already, are followers compared one by one.
6. Connected components over all links.

Every similarity is computed on whole sets.  The order of shingles inside a prefix
uses a sketch of frequent shingles; any order gives the same links.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablekin.llm.common import mixed, partitions_of, small_batches
from tablekin.llm.common import shingle_sets as sets_of
from tablekin.llm.components import connected_components
from tablekin.staging import stage_table

#: Bins of the sketch of frequent shingles, and how many of them are kept at most.
SKETCH_BINS = 1 << 20
SKETCH_KEPT = 1 << 16
#: Minimum hashes that propose leaders, and how many must agree.
LEADER_KEYS, LEADER_AGREE = 8, 2
#: Shingles of a block of followers.
BLOCK_SHINGLES = 1 << 20
#: Buckets of the id filter in front of a join with texts.
FILTER_BUCKETS = 1 << 20


def _need(n: np.ndarray, percent: int) -> np.ndarray:
    """Smallest overlap that a set of n shingles needs with any linked set."""
    return -(-percent * n // 100)


# ---- the sketch of frequent shingles --------------------------------------------------


def _sketch(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(SKETCH_BINS, dtype=np.int64)
        for batch in batches:
            for h in sets_of((t.as_py() for t in batch.column(0)), size):
                # shingles of one text are distinct, their bins nearly
                np.add.at(counts, (h % np.uint64(SKETCH_BINS)).astype(np.int64), 1)
        mean = counts.mean()
        bins = np.flatnonzero(counts > mean + 6 * np.sqrt(mean) + 4)
        yield pa.RecordBatch.from_arrays([pa.array(bins), pa.array(counts[bins])], names=["bin", "count"])

    return run


def frequent_levels(docs: DataFrame, size: int) -> np.ndarray:
    """A rank for each bin: 0 for ordinary ones, else the order of magnitude of its count.

    Each task reports the bins that stand out in its part; at most ``SKETCH_KEPT``
    (the fullest) come to the driver.  The table has a fixed size.
    """
    rows = docs.select(F.col("text").cast("binary").alias("text")).mapInArrow(_sketch(size), "bin long, count long")
    heavy = rows.groupBy("bin").agg(F.sum("count").alias("count")).orderBy(F.desc("count"), "bin").limit(SKETCH_KEPT)
    levels = np.zeros(SKETCH_BINS, dtype=np.uint8)
    for row in heavy.collect():
        levels[row["bin"]] = int(row["count"]).bit_length()
    return levels


# ---- sets -------------------------------------------------------------------------------

SETS = "doc_id long, n int, sig_a long, sig_b long, prefix array<long>, bands array<long>"


def _sets(size: int, percent: int, levels):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level = levels.value
        for batch in batches:
            sizes, sig_a, sig_b, prefixes, bands = [], [], [], [], []
            for h in sets_of((t.as_py() for t in batch.column(1)), size):
                n = h.size
                rank = level[(h % np.uint64(SKETCH_BINS)).astype(np.int64)]
                length = n - int(_need(np.int64(n), percent)) + 1 if n else 0
                ordered = h if not rank.any() else h[np.lexsort((h, rank))]
                prefixes.append(ordered[:length].view(np.int64))
                sizes.append(n)
                sig_a.append(int(mixed(h).sum(dtype=np.uint64).view(np.int64)) if n else 0)
                sig_b.append(int(mixed(h ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64).view(np.int64)) if n else 0)
                bands.append(_bands(h, percent))
            lengths = np.array([len(p) for p in prefixes], dtype=np.int64)
            offsets = pa.array(np.concatenate([[0], np.cumsum(lengths)]), type=pa.int32())
            flat = np.concatenate(prefixes) if prefixes else np.zeros(0, dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(sizes, type=pa.int32()),
                    pa.array(sig_a, type=pa.int64()),
                    pa.array(sig_b, type=pa.int64()),
                    pa.ListArray.from_arrays(offsets, pa.array(flat)),
                    pa.array(bands, type=pa.list_(pa.int64())),
                ],
                names=["doc_id", "n", "sig_a", "sig_b", "prefix", "bands"],
            )

    return run


def _bands(h: np.ndarray, percent: int) -> list[int]:
    """Minimum hashes under a few permutations, each joined with the band of the set's size."""
    if not h.size:
        return []
    band = mixed(np.array([int(np.log(h.size) / -np.log(percent / 100))], dtype=np.uint64))[0]
    k = np.arange(LEADER_KEYS, dtype=np.uint64)
    least = np.array([(h * factor).min() for factor in k * np.uint64(0x9E3779B97F4A7C16) + np.uint64(1)])
    return mixed((least + k * np.uint64(0xD6E8FEB86659FD93)) ^ band).view(np.int64).tolist()


def shingle_sets(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """One row per row of ``docs``: set size, a 128-bit signature, its prefix and its leader keys."""
    levels = docs.sparkSession.sparkContext.broadcast(frequent_levels(docs, size))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(_sets(size, percent, levels), SETS)


# ---- exact comparison ---------------------------------------------------------------------


def _compare(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shared, both = [], []
            left = sets_of((t.as_py() for t in batch.column(2)), size)
            right = sets_of((t.as_py() for t in batch.column(3)), size)
            for a, b in zip(left, right, strict=True):
                place = np.searchsorted(a, b)
                found = int((a[np.minimum(place, a.size - 1)] == b).sum()) if a.size and b.size else 0
                shared.append(found)
                both.append(a.size + b.size - found)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(shared, type=pa.int64()), pa.array(both, type=pa.int64())],
                names=["a", "b", "shared", "both"],
            )

    return run


def _near_ids(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """The ``rows`` of at least the ``ids`` (column id of both), through a filter of fixed size on hashed ids."""
    bucket = F.pmod(F.xxhash64("id"), F.lit(FILTER_BUCKETS)).cast("int")
    wanted = F.broadcast(ids.select(bucket.alias("bucket")).distinct())  # at most FILTER_BUCKETS rows
    return rows.withColumn("bucket", bucket).join(wanted, "bucket", "left_semi").drop("bucket")


def _texts(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(id, text) of ``docs`` for at least the ``ids``."""
    return _near_ids(docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("binary").alias("text")), ids)


def compare_pairs(docs: DataFrame, pairs: DataFrame, size: int) -> DataFrame:
    """Intersection (``shared``) and union (``both``) sizes of the sets of pairs (a, b) of doc_ids.

    Texts pass a filter of fixed size on their ids first, so that those of documents in
    no pair are not shuffled.
    """
    texts = _texts(docs, pairs.select(F.explode(F.array("a", "b")).alias("id")))
    left = texts.select(F.col("id").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("id").alias("b"), F.col("text").alias("text_b"))
    rows = pairs.join(right, "b").join(left, "a").select("a", "b", "text_a", "text_b")
    return rows.mapInArrow(_compare(size), "a long, b long, shared long, both long")


def _links(compared: DataFrame, percent: int) -> DataFrame:
    return compared.where(F.col("shared") * 100 >= F.col("both") * percent)


# ---- index ------------------------------------------------------------------------------

BLOCKS = "token long, leader long, range long, component long"
#: Bits of a packed range for (largest - smallest size) and for the first position; the size comes above.
SPAN_BITS, FIRST_BITS = 20, 12
SPAN, FIRST = (1 << SPAN_BITS) - 1, (1 << FIRST_BITS) - 1


def _pack(least: np.ndarray, most: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sizes and first position in one number; a span or position beyond its bits is stored as the loosest one."""
    span = np.minimum(most - least, SPAN)
    return (least << (SPAN_BITS + FIRST_BITS)) | (span << FIRST_BITS) | np.minimum(first, FIRST)


def _unpack(packed: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    least, span = packed >> (SPAN_BITS + FIRST_BITS), (packed >> FIRST_BITS) & SPAN
    return least, np.where(span == SPAN, np.int64(1) << 40, least + span), packed & FIRST


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Posts of a batch of classes, those of one leader for one token folded into a block."""
    for batch in batches:
        leader, n, component = (batch.column(k).to_numpy() for k in (0, 1, 3))
        lists = batch.column(2)
        lengths = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        token = lists.flatten().to_numpy()
        if not token.size:
            continue
        row = np.repeat(np.arange(leader.size), lengths)
        position = np.arange(token.size) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        order = np.lexsort((leader[row], token))
        token, row, position = token[order], row[order], position[order]
        who, size = leader[row], n[row].astype(np.int64)
        new = np.flatnonzero(np.concatenate([[True], (token[1:] != token[:-1]) | (who[1:] != who[:-1])]))
        least, most = np.minimum.reduceat(size, new), np.maximum.reduceat(size, new)
        packed = _pack(least, most, np.minimum.reduceat(position, new))
        columns = [token[new], who[new], packed, component[row][new]]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["token", "leader", "range", "component"])


def _leader_pairs(percent: int):
    """Pairs (a, b) of leaders whose blocks leave room for a link; rows come sorted by (token, range).

    Blocks of one component, of sizes too far apart, or whose first positions leave less
    than the overlap needed are skipped here, so that they cost no row.  Rows that no
    later, larger block can reach leave the memory.  The smallest position of two linked
    sets' first common shingle always leaves room, so every link is met in some list.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((4, 0), dtype=np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = np.concatenate([held, np.stack([batch.column(k).to_numpy() for k in range(4)])], axis=1)
            token, leader, component = rows[0], rows[1], rows[3]
            least, most, first = _unpack(rows[2])
            # each new row against the rows of its list at distance 1, 2, 3, ... before it
            here, step, out = np.arange(held.shape[1], token.size), 1, []
            while here.size:
                here = here[here >= step]
                here = here[token[here - step] == token[here]]
                x, y = here - step, here
                fits = (most[x] * 100 >= least[y] * percent) & (component[x] != component[y])
                x, y = x[fits], y[fits]
                rest = np.minimum(most[x] - first[x], most[y] - first[y])
                room = rest * (100 + percent) >= percent * (least[x] + least[y])
                x, y = leader[x[room]], leader[y[room]]
                if x.size:
                    out.append(np.stack([np.minimum(x, y), np.maximum(x, y)]))
                step += 1
            last = (token == token[-1]) & (most * 100 >= least[-1] * percent)
            held = rows[:, last]
            if out:
                met = np.unique(np.concatenate(out, axis=1), axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(met[0]), pa.array(met[1])], names=["a", "b"])

    return run


def _marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sixteen bits of each shingle of a prefix, sorted."""
    for batch in batches:
        lists = batch.column(2)
        ends = np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False))
        bits = (mixed(lists.flatten().to_numpy().view(np.uint64)) >> np.uint64(48)).astype("<u2")
        marks = [np.sort(part).tobytes() for part in np.split(bits, ends[:-1])]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(marks, pa.binary())], names=["id", "n", "marks"])


def _enough(percent: int):
    """Pairs whose prefixes may share what a link needs of them; a pair without marks on a side passes.

    Past the prefix that ends first, two sets share at most percent hundredths of the
    larger one (what that prefix leaves over).  The rest of the overlap needed,
    percent * (x + y) / (100 + percent), must lie in both prefixes.  Equal marks of
    different shingles only raise the count.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x_n, x, y_n, y in zip(*(batch.column(k).to_pylist() for k in range(2, 6)), strict=True):
                if not x or not y:
                    keep.append(True)
                    continue
                x, y = np.frombuffer(x, dtype="<u2"), np.frombuffer(y, dtype="<u2")
                shared = int((y[np.minimum(np.searchsorted(y, x), y.size - 1)] == x).sum())
                asked = (min(x_n, y_n) * 100 - max(x_n, y_n) * percent) * percent
                keep.append(shared * 100 * (100 + percent) >= asked)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _candidates(blocks: DataFrame, sets: DataFrame, followers: DataFrame, percent: int, partitions: int) -> DataFrame:
    """Pairs of leaders (a, b) that may link, or whose followers may."""
    blocks = blocks.repartition(partitions, "token").sortWithinPartitions("token", "range")
    met = stage_table(blocks.mapInArrow(_leader_pairs(percent), "a long, b long").distinct(), "ngram-met")
    rows = sets.select(F.col("doc_id").alias("id"), "n", "prefix")
    marks = _near_ids(rows, met.select(F.explode(F.array("a", "b")).alias("id"))).mapInArrow(_marks, "id long, n int, marks binary")
    # A leader's followers may link where it does not: it has no marks and all its pairs pass.
    marks = marks.distinct().join(followers.select(F.col("leader").alias("id")).distinct(), "id", "left_anti")
    sides = [marks.select(F.col("id").alias(k), F.col("n").alias(f"n_{k}"), F.col("marks").alias(f"marks_{k}")) for k in ("a", "b")]
    rows = met.join(sides[1], "b", "left").join(sides[0], "a", "left").select("a", "b", "n_a", "marks_a", "n_b", "marks_b")
    return rows.mapInArrow(_enough(percent), "a long, b long").distinct()


def _block_links(size: int, percent: int):
    """Classes y against one block of the classes x that follow a leader: at most one link per y and block.

    ``distance`` is that of the two leaders; classes that distances or sizes rule out are not looked at.
    """

    def run(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        found_a, found_b = [], []
        if left.num_rows and right.num_rows:
            x_id, x_away = left["x_cls"].to_numpy(), left["x_away"].to_numpy()
            x_sets = list(sets_of((t.as_py() for t in left["x_text"]), size))
            x_n = np.array([x.size for x in x_sets])
            y_rows = zip(*(right[c].to_pylist() for c in ("y_cls", "y_away", "distance")), strict=True)
            for (y, away, distance), h in zip(y_rows, sets_of((t.as_py() for t in right["y_text"]), size), strict=True):
                open_x = (x_away + away + 1 - percent / 100 + 1e-9 >= distance) & (x_away + away > 0)
                open_x &= np.minimum(x_n, h.size) * 100 >= np.maximum(x_n, h.size) * percent
                for k in np.flatnonzero(open_x).tolist():
                    x = x_sets[k]
                    place = np.minimum(np.searchsorted(x, h), x.size - 1)
                    shared = int((x[place] == h).sum())
                    if shared * 100 >= (x.size + h.size - shared) * percent:
                        found_a.append(int(x_id[k]))
                        found_b.append(y)
                        break
        return pa.table([pa.array(found_a, pa.int64()), pa.array(found_b, pa.int64())], names=["a", "b"])

    return run


def _near_leaders(compared: DataFrame, led: DataFrame, percent: int) -> DataFrame:
    """Leader pairs near enough for followers to link although the leaders do not.

    ``large`` is the side with the larger following, to be cut into ``blocks`` of about ``BLOCK_SHINGLES``.
    """
    facts = led.groupBy("leader").agg(F.max("away").alias("reach"), F.sum("n").alias("mass"))
    distance = (1 - F.col("shared") / F.col("both")).alias("distance")
    near = compared.where(F.col("shared") * 100 < F.col("both") * percent).select("a", "b", distance)
    for end in ("a", "b"):
        near = near.join(facts.select(F.col("leader").alias(end), *[F.col(c).alias(f"{c}_{end}") for c in ("reach", "mass")]), end)
    far = F.col("reach_a") + F.col("reach_b")
    near = near.where((far > 0) & (F.col("distance") <= far + (1 - percent / 100) + 1e-9))
    more = F.col("mass_a") >= F.col("mass_b")
    near = near.select(
        F.when(more, F.col("a")).otherwise(F.col("b")).alias("large"),
        F.when(more, F.col("b")).otherwise(F.col("a")).alias("small"),
        F.ceil(F.greatest("mass_a", "mass_b") / BLOCK_SHINGLES).cast("int").alias("blocks"),
        "distance",
    )
    return stage_table(near, "ngram-near")


def _follower_links(docs: DataFrame, led: DataFrame, near: DataFrame, size: int, percent: int) -> DataFrame:
    """Links (a, b) between classes led by the leader pairs ``near``: the classes of the smaller side meet every block."""
    ids = near.select(F.explode(F.array("large", "small")).alias("leader")).distinct()
    own = stage_table(led.select("leader", "cls", "away").join(ids, "leader", "left_semi"), "ngram-own")
    own = own.join(_texts(docs, own.select(F.col("cls").alias("id"))), F.col("cls") == F.col("id")).drop("id")
    large = near.select("large", "blocks").distinct()
    x = own.join(large, F.col("leader") == F.col("large"))
    x = x.select(
        "large",
        F.pmod(F.xxhash64("cls"), "blocks").cast("int").alias("block"),
        *[F.col(c).alias(f"x_{c}") for c in ("cls", "away", "text")],
    )
    y = near.join(own, F.col("small") == F.col("leader"))
    y = y.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    y = y.select(F.col("large").alias("of_large"), F.col("block").alias("of_block"), "distance", *[F.col(c).alias(f"y_{c}") for c in ("cls", "away", "text")])
    pairs = x.groupBy("large", "block").cogroup(y.groupBy("of_large", "of_block"))
    return stage_table(pairs.applyInArrow(_block_links(size, percent), "a long, b long"), "ngram-follower-links")


# ---- the join -----------------------------------------------------------------------------


def _of_components(links: DataFrame, tied: DataFrame) -> DataFrame:
    """``links`` (a, b) between the components of ``tied`` (node, component) that their ends lie in."""
    for end in ("a", "b"):
        of = tied.select(F.col("node").alias(end), F.col("component").alias("of"))
        links = links.join(of, end, "left").withColumn(end, F.coalesce("of", end)).drop("of")
    return links.where("a != b").select("a", "b")


def _leaders(docs: DataFrame, classes: DataFrame, size: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Links of classes with leaders, and per following class its leader and the distance to it.

    Each key proposes two leaders: its most central class (whose keys have most members,
    so that few of its shingles are its own), whose followers fold in the index, and one
    that depends on the key (the least after a bitwise mask), which ties together
    groups whose members are not all near the central one.
    """
    keys = classes.select("cls", F.explode("bands").alias("key"))
    members = keys.groupBy("key").agg(F.count("*").alias("members")).where("members > 1")
    # A class has LEADER_KEYS keys, so summing over them needs no aggregate of its own.
    weight = F.sum("members").over(Window.partitionBy("cls")).alias("weight")
    keys = stage_table(keys.join(members, "key").select("cls", "key", weight), "ngram-keys")
    mask = F.col("key").bitwiseAND(F.lit((1 << 62) - 1))
    led = keys.groupBy("key").agg(
        F.max(F.struct("weight", (-F.col("cls")).alias("cls"))).alias("central"),
        F.min(F.col("cls").bitwiseXOR(mask)).alias("masked"),
    )
    leaders = F.array(-F.col("central.cls"), F.col("masked").bitwiseXOR(mask)).alias("leaders")
    led = led.select("key", F.col("central.weight").alias("leader_weight"), leaders)
    met = keys.join(led, "key").select("cls", "weight", "leader_weight", F.posexplode("leaders").alias("kind", "leader"))
    # The least kind comes with the weight of that leader, which only a central one (kind 0) needs.
    met = met.where("cls != leader").groupBy("cls", "leader").agg(F.min(F.struct("kind", "weight", "leader_weight")).alias("met"))
    bands = classes.select(F.col("cls").alias("leader"), F.col("bands").alias("leader_bands"))
    met = met.join(classes, "cls").join(bands, "leader")
    met = met.where(F.size(F.array_intersect("bands", "leader_bands")) >= LEADER_AGREE).select("cls", "leader", "met.*")
    met = stage_table(met, "ngram-proposed")
    pairs = met.select(F.least("cls", "leader").alias("a"), F.greatest("cls", "leader").alias("b")).distinct()
    links = stage_table(_links(compare_pairs(docs, pairs, size), percent), "ngram-leaders")
    away = (1 - F.col("shared") / F.col("both")).alias("away")
    sides = F.array(F.struct(F.col("a").alias("cls"), F.col("b").alias("leader")), F.struct(F.col("b").alias("cls"), F.col("a").alias("leader")))
    followers = links.select(away, F.explode(sides).alias("side")).select("side.cls", "side.leader", "away")
    followers = followers.join(met.where("kind = 0").drop("kind"), ["cls", "leader"])
    # The more central one leads, the smaller id if both are equally central.
    leads = F.struct(F.col("leader_weight"), -F.col("leader")) > F.struct(F.col("weight"), -F.col("cls"))
    followers = followers.where(leads).select("cls", "leader", "away")
    # A leader must follow nobody, or distances would not be direct.
    followers = followers.join(followers.select(F.col("cls").alias("leader")).distinct(), "leader", "left_anti")
    nearest = F.min(F.struct("away", "leader")).alias("nearest")
    chosen = followers.groupBy("cls").agg(nearest).select("cls", "nearest.leader", "nearest.away")
    return links.select("a", "b"), stage_table(chosen, "ngram-followers")


def similarity_classes(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_shingles and component_id.

    Two documents link when the Jaccard similarity of their sets of ``size``-word
    shingles is at least ``percent`` hundredths; component_id is the smallest doc_id
    that links reach.  Texts with fewer words are one shingle; texts without words
    and null texts have no shingle and their own id.  Rows of equal ids count as
    one document; a null id gets its class's id if its set equals that of another
    row, else null.  Ties cannot occur.  An empty table gives no rows.
    """
    docs = small_batches(docs.select("doc_id", "text"))
    sets = stage_table(shingle_sets(docs, size, percent), "ngram-sets")
    narrow = sets.select("doc_id", "n", "sig_a", "sig_b")
    equal = narrow.where("n > 0").groupBy("n", "sig_a", "sig_b").agg(F.min("doc_id").alias("cls"))
    equal = stage_table(equal.where("cls IS NOT NULL"), "ngram-equal")
    # One row per class; rows that repeat an id and a set fold here too.
    one = sets.join(equal.withColumnRenamed("cls", "doc_id"), ["doc_id", "n", "sig_a", "sig_b"])
    one = stage_table(one.select(F.col("doc_id").alias("cls"), "bands"), "ngram-classes")
    star, followers = _leaders(docs, one, size, percent)
    tied = stage_table(connected_components(star), "ngram-tied")
    # Written without prefixes, which are joined once; each plan below stays small on the driver.
    place = equal.join(tied.withColumnRenamed("node", "cls"), "cls", "left").join(followers, "cls", "left")
    place = place.withColumns({k: F.coalesce(k, "cls") for k in ("leader", "component")})
    led = stage_table(place.withColumn("away", F.coalesce("away", F.lit(0.0))), "ngram-led")

    posts = sets.drop("bands").join(led.withColumnRenamed("cls", "doc_id"), ["doc_id", "n", "sig_a", "sig_b"])
    blocks = posts.select("leader", "n", "prefix", "component").mapInArrow(_blocks, BLOCKS)
    pairs = stage_table(_candidates(blocks, sets, followers, percent, partitions_of(docs)), "ngram-pairs")
    compared = stage_table(compare_pairs(docs, pairs, size), "ngram-compared")
    links = _links(compared, percent).select("a", "b")
    near = _near_leaders(compared, led, percent)
    if not near.isEmpty():
        links = links.unionByName(_follower_links(docs, led, near, size, percent))
    links = _of_components(links, tied)
    tops = connected_components(links).withColumnRenamed("component", "top")
    labels = tied.join(tops.withColumnRenamed("node", "component"), "component", "left")
    labels = labels.select("node", F.coalesce("top", "component").alias("component"))
    labels = labels.unionByName(tops.join(tied, "node", "left_anti").withColumnRenamed("top", "component"))
    placed = narrow.join(equal, ["n", "sig_a", "sig_b"], "left").join(labels, F.col("cls") == F.col("node"), "left")
    return placed.select(
        "doc_id",
        F.col("n").cast("long").alias("n_shingles"),
        F.coalesce("component", "cls", "doc_id").alias("component_id"),
    )
