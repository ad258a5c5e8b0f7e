"""Mixing sources to target weights with a splitting tree over permuted blocks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablekin.llm.common import word_count
from tablekin.staging import stage_table

#: Hex digits of the row key that name a block: 256 blocks per source.
BLOCK_DIGITS = 2


def row_key(doc_id: Column, seed: str) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"))


def source_targets(sizes: DataFrame, weights: tuple[int, ...], share: float, cap: float) -> DataFrame:
    """Words each source should give: ``share`` of all words by weight, none above ``cap`` times its own.

    ``sizes`` has one row per source (source, source_size).  Sources that would
    pass their cap stop there and the rest shares the excess by weight; sorted by
    cap per weight this is one running sum: the first level that the next source
    can still bear is the answer.  The unpartitioned windows hold one row per source.
    """
    in_order = Window.orderBy(F.col("source").asc_nulls_last())
    number = (F.row_number().over(in_order) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (number + 1).cast("int"))
    rows = sizes.select("source", "source_size", weight.alias("weight"))
    rows = rows.withColumn("limit", F.col("source_size") * F.lit(float(cap)))
    full = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    before = full.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    level = (
        F.sum("source_size").over(everything) * F.lit(float(share)) - F.coalesce(F.sum("limit").over(before), F.lit(0.0))
    ) / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    rows = rows.withColumn("level", level)
    borne = F.when(F.col("level") <= F.col("limit") / F.col("weight"), F.col("level"))
    # Levels rise up to the right one and fall after it.
    rows = rows.withColumn("level", F.max(borne).over(everything))
    target = F.when(F.col("level").isNull(), F.col("limit")).otherwise(
        F.least(F.col("limit"), F.col("level") * F.col("weight"))
    )
    return rows.select("source", "source_size", target.alias("target"))


def splitting_tree(units: DataFrame, levels: int, seed: str) -> DataFrame:
    """Deal the rows of ``units`` (source, pass, block) to 2^levels shards.

    A node draws half of its blocks without replacement and hands them to its left
    child, so the numbers per source are a multivariate hypergeometric draw and add
    up exactly to the quotas above; the blocks of the shards are disjoint.
    """
    nodes = units.withColumn("shard", F.lit(0))
    for level in range(levels):
        name = F.concat_ws("|", F.lit(f"{seed}|{level}"), "source", "pass", "block")
        draw = Window.partitionBy("shard").orderBy(F.md5(name.cast("binary")), "source", "pass", "block")
        left = F.row_number().over(draw) * 2 <= F.count("*").over(Window.partitionBy("shard"))
        nodes = nodes.withColumn("shard", F.col("shard") * 2 + F.when(left, 0).otherwise(1))
    return nodes


def mix_plan(
    docs: DataFrame,
    weights: tuple[int, ...] = (3, 1, 2),
    share: float = 1.5,
    cap: float = 2.0,
    levels: int = 4,
    seed: str = "mix",
) -> DataFrame:
    """How often, and in which output shards, the mix takes each row of ``docs`` (doc_id, text, source).

    Rows get a key from their id; its first digits name the block.  A source whose
    target is r times its size is taken floor(r) times whole, then block after block
    in key order until the rest is used up.  Inside the last block whole documents
    are taken while they fit, and then one more document of those left over, the one
    whose size comes nearest to the gap, if that brings the source nearer.  Blocks of all passes go
    through the splitting tree.

    Returns doc_id, size, source, source_size, target, taken, copies, shards
    (one output shard per copy) and row_key, one row per input row.  A null text has
    size 0, a null source is a source of its own (last), null ids get the key of
    empty text, equal ids share a block.  An empty table gives no rows.
    """
    rows = docs.select(
        "doc_id", F.col("source").cast("string").alias("source"), word_count(F.col("text")).alias("size")
    ).withColumn("row_key", row_key(F.col("doc_id"), seed))
    rows = stage_table(rows.withColumn("block", F.substring("row_key", 1, BLOCK_DIGITS)), "mix-rows")
    blocks = rows.groupBy("source", "block").agg(F.sum("size").alias("words"))
    sizes = blocks.groupBy("source").agg(F.sum("words").alias("source_size"))
    targets = source_targets(sizes, weights, share, cap)
    whole = F.when(F.col("source_size") == 0, F.lit(0)).otherwise(
        F.floor(F.col("target") / F.col("source_size"))
    )
    targets = targets.withColumn("passes", whole.cast("int")).withColumn(
        "rest", F.col("target") - F.col("passes") * F.col("source_size")
    )

    # One row per source and block from here on: the plan of the passes.
    same = blocks["source"].eqNullSafe(targets["source"])
    plan = blocks.join(targets, same).select(blocks["*"], "source_size", "target", "passes", "rest")
    until = Window.partitionBy("source").orderBy("block").rowsBetween(Window.unboundedPreceding, 0)
    plan = plan.withColumn("before", F.sum("words").over(until) - F.col("words"))
    state = (
        F.when(F.col("before") + F.col("words") <= F.col("rest"), F.lit("whole"))
        .when(F.col("before") < F.col("rest"), F.lit("edge"))
        .otherwise(F.lit("out"))
    )
    plan = plan.withColumn("state", F.when(F.col("rest") > 0, state).otherwise(F.lit("out")))
    drawn = F.col("passes") + (F.col("state") != "out").cast("int")
    units = plan.where(drawn > 0).select(
        "source", "block", F.explode(F.sequence(F.lit(0), drawn - 1)).alias("pass")
    )
    shards = (
        splitting_tree(units, levels, seed)
        .groupBy(F.col("source").alias("unit_source"), F.col("block").alias("unit_block"))
        .agg(F.transform(F.array_sort(F.collect_list(F.struct("pass", "shard"))), lambda x: x["shard"]).alias("dealt"))
    )
    same = (plan["block"] == shards["unit_block"]) & plan["source"].eqNullSafe(shards["unit_source"])
    plan = plan.join(shards, same, "left").drop("unit_source", "unit_block")
    plan = stage_table(
        plan.select(
            F.col("source").alias("plan_source"),
            F.col("block").alias("plan_block"),
            "source_size",
            "target",
            "passes",
            "state",
            (F.col("rest") - F.col("before")).alias("room"),
            "dealt",
        ),
        "mix-plan",
    )
    same = (rows["block"] == plan["plan_block"]) & rows["source"].eqNullSafe(plan["plan_source"])
    placed = rows.join(plan, same).drop("plan_source", "plan_block")

    # Inside the last block: whole documents while they fit, then the best single one of those left over.
    last = Window.partitionBy("source").orderBy("row_key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    fits = F.sum("size").over(last) <= F.col("room")
    edge = placed.where("state = 'edge'").withColumn("more", fits.cast("int"))
    gaps = edge.groupBy(F.col("source").alias("gap_source")).agg(
        (F.max("room") - F.sum(F.col("size") * F.col("more"))).alias("gap")
    )
    others = placed.where("state != 'edge'").withColumn("more", (F.col("state") == "whole").cast("int"))
    placed = edge.unionByName(others)
    left = placed.where("more = 0").join(gaps, F.col("source").eqNullSafe(F.col("gap_source")))
    off = F.abs(F.col("size") - F.col("gap"))
    best = (
        left.where(off < F.col("gap"))
        .groupBy(F.col("source").alias("best_source"))
        .agg(F.min(F.struct(off.alias("off"), "row_key", "doc_id", "size")).alias("best"))
    )
    placed = placed.join(best, F.col("source").eqNullSafe(F.col("best_source")), "left")
    chosen = (
        (F.col("more") == 0)
        & (F.col("row_key") == F.col("best.row_key"))
        & F.col("doc_id").eqNullSafe(F.col("best.doc_id"))
        & (F.col("size") == F.col("best.size"))
    )
    placed = placed.withColumn("chosen", F.coalesce(chosen, F.lit(False))).drop("best", "best_source")
    alike = Window.partitionBy("source", "row_key", "doc_id", "size").orderBy(F.lit(1))
    extra = placed.where("chosen").withColumn("more", (F.row_number().over(alike) == 1).cast("int"))
    placed = placed.where("NOT chosen").unionByName(extra)
    copies = F.col("passes") + F.col("more")
    return placed.select(
        "doc_id",
        "size",
        "source",
        "source_size",
        "target",
        (copies * F.col("size")).cast("long").alias("taken"),
        copies.alias("copies"),
        F.when(copies == 0, F.array().cast("array<int>"))
        .otherwise(F.transform(F.sequence(F.lit(1), copies), lambda i: F.coalesce(F.try_element_at("dealt", i), F.lit(0))))
        .alias("shards"),
        "row_key",
    )


def mix_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: every row of ``docs`` as often as the plan takes it, with its output shard.

    ``shard`` and ``mix_order`` are added (replacing columns of these names); sort each
    shard by ``mix_order`` for the local shuffle.
    """
    plan = mix_plan(docs, **options)
    size = F.col("size")
    plan = plan.where("copies > 0").select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("_id"),
        size.alias("_size"),
        F.col("source").alias("_source"),
        "shards",
        "row_key",
    )
    # Rows that agree in id, source and size are numbered on both sides, so that repeated rows pair one to one.
    sides = Window.partitionBy("_id", "_source", "_size").orderBy(F.size("shards").desc())
    plan = plan.withColumn("_number", F.row_number().over(sides))
    named = docs.withColumns(
        {
            "_id": F.coalesce(F.col("doc_id").cast("string"), F.lit("")),
            "_source": F.col("source").cast("string"),
            "_size": word_count(F.col("text")),
        }
    )
    rows = Window.partitionBy("_id", "_source", "_size").orderBy(F.md5(F.col("text").cast("binary")))
    named = named.withColumn("_number", F.row_number().over(rows))
    same = (
        (named["_id"] == plan["_id"])
        & (named["_size"] == plan["_size"])
        & (named["_number"] == plan["_number"])
        & named["_source"].eqNullSafe(plan["_source"])
    )
    mixed = named.join(plan, same).select(*[named[c] for c in docs.columns if c not in ("shard", "mix_order")], "shards", "row_key")
    mixed = mixed.select("*", F.posexplode("shards").alias("_copy", "shard"))
    order = F.md5(F.concat_ws("|", "row_key", F.col("_copy").cast("string")).cast("binary"))
    return mixed.withColumn("mix_order", order).drop("shards", "row_key", "_copy")
