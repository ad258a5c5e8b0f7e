"""Queries over the test tables and their SQL twins."""

from __future__ import annotations

import importlib.util
import os
import sys
from collections.abc import Callable
from datetime import datetime
from functools import reduce

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablekin.functions.draw import draw_between
from tablekin.functions.rules import RuleContext, rule_column
from tablekin.operators import changes, ordering, relational, skew, synthesis
from tablekin.plans import catalog, constraints, inclusion
from tablekin.plans.declarations import constraint_spec
from tablekin.plans.filling import fill_tables
from tablekin.plans.keys import find_keys
from tablekin.sources.keyed import merge_keyed, write_keyed
from tablekin.sources.lake import inline_rows, read_tables, run_sql, write_description, write_table
from tablekin.staging import new_path

# Columns and types of the test tables.
COLUMNS = """
region: r_regionkey int, r_name string
nation: n_nationkey int, n_name string, n_regionkey int
customer: c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string
supplier: s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double
part: p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double
orders: o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string
lineitem: l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz
events: event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string
documents: doc_id bigint, text string, lang string, source string, n_chars bigint
embeddings: vec_id bigint, embedding array<float>, label int
pages: page_id bigint, url string, html string
benchmark: item_id bigint, text string
labels: doc_id bigint, quality int, toxic int
conversations: conv_id bigint, turn bigint, role string, text string
"""
TABLES = {
    line.split(": ")[0]: [tuple(c.split(" ")) for c in line.split(": ")[1].split(", ")]
    for line in COLUMNS.strip().splitlines()
}

# Keys and rules of the test tables.
SPEC = {
    "region": {"primary_key": ["r_regionkey"], "unique": [["r_name"]], "not_null": ["r_name"]},
    "nation": {
        "primary_key": ["n_nationkey"],
        "unique": [["n_name"]],
        "foreign_keys": [{"from_columns": ["n_regionkey"], "to_table": "region"}],
    },
    "customer": {
        "primary_key": ["c_custkey"],
        "unique": [["c_name"]],
        "not_null": ["c_name"],
        "foreign_keys": [{"from_columns": ["c_nationkey"], "to_table": "nation"}],
    },
    "supplier": {
        "primary_key": ["s_suppkey"],
        "foreign_keys": [{"from_columns": ["s_nationkey"], "to_table": "nation"}],
    },
    "part": {"primary_key": ["p_partkey"], "checks": {"size": "p_size BETWEEN 1 AND 40"}},
    "orders": {
        "primary_key": ["o_orderkey"],
        "not_null": ["o_custkey", "o_orderdate"],
        "checks": {
            "status": "o_orderstatus IN ('F', 'O', 'P')",
            "price": "o_totalprice <= 400000",
        },
        "foreign_keys": [{"from_columns": ["o_custkey"], "to_table": "customer"}],
    },
    "lineitem": {
        "primary_key": ["l_orderkey", "l_linenumber"],
        "not_null": ["l_quantity"],
        "checks": {"discount": "l_discount <= 0.05"},
        "foreign_keys": [
            {"from_columns": ["l_orderkey"], "to_table": "orders"},
            {"from_columns": ["l_partkey"], "to_table": "part"},
            {"from_columns": ["l_suppkey"], "to_table": "supplier"},
        ],
    },
    "documents": {"primary_key": ["doc_id"], "unique": [["text"]]},
    "labels": {
        "primary_key": ["doc_id"],
        "foreign_keys": [{"from_columns": ["doc_id"], "to_table": "documents"}],
    },
    "conversations": {"primary_key": ["conv_id", "turn"]},
}

ANCHOR = datetime(2024, 2, 1, 12, 0, 0)
PRIORITIES = ["low", "medium", "high"]
WEEKDAYS = ["monday", "wednesday", "thursday", "saturday"]

Query = Callable[[SparkSession, str], DataFrame]


def _all(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return read_tables(spark, folder, TABLES)


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


# ---- sources, sinks and relational queries ----------------------------------------


def adhoc_sql(spark, sf):
    tables = read_tables(spark, sf, ["orders", "customer"])
    return run_sql(
        spark,
        tables,
        """SELECT c_mktsegment AS segment, count(*) AS orders, min(o_totalprice) AS cheapest
           FROM orders JOIN customer ON o_custkey = c_custkey
           WHERE o_orderstatus = 'F' GROUP BY c_mktsegment;""",
    )


def inline_join(spark, sf):
    schema = T.StructType(
        [
            T.StructField("id", T.LongType()),
            T.StructField("code", T.StringType()),
            T.StructField("meaning", T.StringType()),
            T.StructField("weight", T.DoubleType()),
        ]
    )
    records = [{"code": "F", "meaning": "finished"}, {"code": "O", "meaning": None, "weight": 2}, {"code": "X"}]
    codes = inline_rows(spark, records, schema, "id", defaults={"meaning": "unknown", "weight": 1})
    orders = _table(spark, sf, "orders")
    return relational.count_per_parent(codes, "code", orders, "o_orderstatus", "o_orderkey", "orders")


def table_sink(spark, sf):
    path = new_path(spark, "table-sink")
    orders = _table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_custkey")
    write_table(orders, path)
    write_table(orders.where("o_orderstatus = 'F'"), path)
    return write_table(orders.where("o_orderstatus = 'P'"), path, overwrite=False)


def description_sink(spark, sf):
    tables = _all(spark, sf)
    described = catalog.table_descriptions(
        catalog.column_rows(spark, tables, SPEC), catalog.key_rows(spark, SPEC)
    ).join(catalog.table_sizes(tables), "table_name")
    text = F.to_json(F.struct("table_name", "row_count", "columns", "primary_key", "foreign_keys"))
    path = write_description(described.select(text.alias("value")), new_path(spark, "description"), "lake.db")
    return spark.read.text(path).withColumnRenamed("value", "document")


def project_alias(spark, sf):
    return _table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("order_key"),
        F.col("l_quantity").alias("quantity"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("net_price"),
    )


def concat_name(spark, sf):
    parts = synthesis.inject_nulls(_table(spark, sf, "part"), "p_partkey", "p_type", 0.2, "concat")
    return parts.select("p_partkey", relational.joined_text("p_brand", "p_type").alias("label"))


def filter_not_like(spark, sf):
    chosen = (F.col("p_type") == "ECONOMY") & relational.without_prefix("p_name", "red")
    return _table(spark, sf, "part").where(chosen).select("p_partkey", "p_name")


def join_inner(spark, sf):
    t = read_tables(spark, sf, ["orders", "customer", "nation"])
    joined = relational.join_dimensions(
        t["orders"], (t["customer"], "o_custkey", "c_custkey"), (t["nation"], "c_nationkey", "n_nationkey")
    )
    return joined.select("o_orderkey", "c_name", "n_name")


def join_same_name(spark, sf):
    t = read_tables(spark, sf, ["documents", "labels"])
    documents = t["documents"].select("doc_id", "lang", "source", "n_chars")
    return relational.join_dimensions(documents, (t["labels"], "doc_id", "doc_id"))


def join_left(spark, sf):
    orders = _table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    items = _table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    return skew.join_children(orders, "o_orderkey", items, "l_orderkey")


def join_left_skewed(spark, sf):
    """Sources and languages with their documents; the hottest pair is split over salts."""
    documents = _table(spark, sf, "documents").select("lang", "source", "doc_id", "n_chars")
    groups = documents.select("lang", "source").distinct()
    others = groups.withColumn("source", F.concat("source", F.lit("-archive")))
    return skew.join_children(groups.unionAll(others), ["source", "lang"], documents, ["source", "lang"], hot_bytes=1)


def count_per_parent(spark, sf):
    orders = _table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    items = _table(spark, sf, "lineitem")
    return relational.count_per_parent(orders, "o_orderkey", items, "l_orderkey", "l_partkey", "items")


def random_top_k(spark, sf):
    orders = _table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return relational.random_top_k(orders, "o_orderkey", 10, "top")


def limit_k(spark, sf):
    return relational.first_k(_table(spark, sf, "orders").select("o_orderkey", "o_custkey"), ["o_orderkey"], 10)


def parent_child_report(spark, sf):
    t = read_tables(spark, sf, ["customer", "nation", "region"])
    report = relational.parent_child_report(
        t["customer"],
        "c_custkey",
        [(t["nation"], "c_nationkey", "n_nationkey"), (t["region"], "n_regionkey", "r_regionkey")],
        _table(spark, sf, "orders"),
        "o_custkey",
        "o_orderkey",
        "order_count",
        5,
        "report",
    )
    return report.select(
        relational.joined_text("c_name", "c_mktsegment").alias("customer"),
        F.col("n_name").alias("nation"),
        F.col("r_name").alias("region"),
        "order_count",
    )


def keyed_update(spark, sf):
    urgent = (
        _table(spark, sf, "orders")
        .where("o_orderpriority = '1-URGENT'")
        .groupBy("o_custkey")
        .agg(F.max("o_totalprice").alias("highest"))
    )
    customers = _table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")
    return changes.keyed_update(customers, "c_custkey", urgent, "o_custkey", {"c_acctbal": "highest"})


def merge_table(spark, sf):
    """Customers kept by key; the last urgent order of some writes its price as their balance."""
    path = new_path(spark, "keyed")
    write_keyed(_table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal"), path, ["c_custkey"], 32)
    urgent = _table(spark, sf, "orders").where("o_orderpriority = '1-URGENT' AND o_orderstatus = 'P'")
    latest = urgent.selectExpr("o_custkey + 5 AS c_custkey", "o_totalprice AS c_acctbal", "o_orderdate", "o_orderkey")
    return merge_keyed(spark, path, ["c_custkey"], latest, ["o_orderdate", "o_orderkey"])


def shuffle_rank(spark, sf):
    return ordering.shuffle_rank(_table(spark, sf, "orders").select("o_orderkey"), "o_orderkey", "mix")


def shuffle_rank_sparse(spark, sf):
    parts = _table(spark, sf, "part").where("p_size > 10").select("p_partkey")
    return ordering.shuffle_rank(parts, "p_partkey", "blend")


def insert_or_ignore(spark, sf):
    target = (
        _table(spark, sf, "orders")
        .where("o_orderstatus = 'F'")
        .select(
            F.col("o_orderkey").alias("order_key"),
            F.expr("int(1 + o_custkey % 7)").alias("line"),
            F.lit(None).cast("bigint").alias("part_key"),
            F.lit(None).cast("bigint").alias("supplier_key"),
        )
    )
    batch = _table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("order_key"),
        F.col("l_linenumber").alias("line"),
        F.col("l_partkey").alias("part_key"),
        F.col("l_suppkey").alias("supplier_key"),
    )
    return changes.insert_or_ignore(target, batch, ["order_key", "line"], ["part_key", "supplier_key"])


# ---- description ------------------------------------------------------------------


def catalog_tables(spark, sf):
    return catalog.table_sizes(_all(spark, sf))


def catalog_columns(spark, sf):
    return catalog.observed_columns(_all(spark, sf), SPEC)


def primary_keys(spark, sf):
    declared = catalog.primary_keys(catalog.key_rows(spark, SPEC))
    facts = catalog.key_facts(read_tables(spark, sf, SPEC), SPEC)
    return declared.join(facts, "table_name").select(
        "table_name", F.array_join("columns", ", ").alias("key_columns"), "row_count", "key_count"
    )


def _declared_links():
    return [
        catalog.Link(
            table,
            tuple(fk["from_columns"]),
            fk["to_table"],
            tuple(constraints.referenced_columns(SPEC, fk)),
        )
        for table, declared in SPEC.items()
        for fk in declared.get("foreign_keys", [])
    ]


def _link_facts(spark, sf):
    return catalog.observed_relationships(read_tables(spark, sf, SPEC), _declared_links())


def foreign_keys(spark, sf):
    declared = catalog.foreign_keys(catalog.key_rows(spark, SPEC)).select(
        F.col("table_name").alias("from_table"),
        "to_table",
        F.array_join("from_columns", ", ").alias("from_columns"),
        F.array_join("to_columns", ", ").alias("to_columns"),
    )
    link = F.concat("from_columns", F.lit(" -> "), "to_columns")
    facts = _link_facts(spark, sf).select("from_table", "to_table", "on", "child_rows", "orphan_keys")
    return declared.withColumn("on", link).join(facts, ["from_table", "to_table", "on"]).drop("on")


def relationships(spark, sf):
    declared = catalog.relationships(catalog.key_rows(spark, SPEC)).withColumnRenamed("type", "declared_type")
    facts = _link_facts(spark, sf).select("from_table", "to_table", "on", F.col("type").alias("observed_type"))
    return declared.join(facts, ["from_table", "to_table", "on"]).withColumnRenamed("on", "link")


def column_profile(spark, sf):
    return catalog.column_profile(_all(spark, sf), exact=True).drop("distinct_estimate")


def key_candidates(spark, sf):
    return find_keys(_all(spark, sf), max_columns=2)


def discovered_relationships(spark, sf):
    found = inclusion.discovered_relationships(_all(spark, sf), inclusion.keys_of(SPEC))
    return found.drop("contained").withColumnRenamed("on", "link")


def observed_relationships(spark, sf):
    tables = _all(spark, sf)
    links = catalog.candidate_links(tables, SPEC)
    links.append(catalog.Link("events", ("user_id",), "customer", ("c_custkey",)))
    links.append(catalog.Link("part", ("p_size",), "nation", ("n_nationkey",)))
    return catalog.observed_relationships(tables, links).withColumnRenamed("on", "link")


# ---- constraint checks ------------------------------------------------------------


def _orders_with_gaps(spark, sf):
    orders = _table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    return synthesis.inject_nulls(orders, "o_orderkey", "o_orderpriority", 0.25, "gaps")


def check_not_null(spark, sf):
    return constraints.check_not_null(_orders_with_gaps(spark, sf), "o_orderpriority")


def check_unique(spark, sf):
    return constraints.check_unique(_orders_with_gaps(spark, sf), ["o_custkey", "o_orderpriority"])


def check_primary_key(spark, sf):
    return constraints.check_primary_key(_orders_with_gaps(spark, sf), ["o_custkey", "o_orderpriority"])


def check_expr(spark, sf):
    items = _table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_discount")
    return constraints.check_expr(items, "l_discount <= 0.05 OR l_linenumber = 1")


def check_foreign_key(spark, sf):
    items, parts = _table(spark, sf, "lineitem"), _table(spark, sf, "part").where("p_size <= 40")
    return constraints.check_foreign_key(items, ["l_partkey"], parts, ["p_partkey"])


def apply_default(spark, sf):
    orders = _orders_with_gaps(spark, sf).drop("o_custkey")
    return constraints.apply_defaults(orders, {"o_orderpriority": "5-LOW", "channel": "web"})


def constraint_report(spark, sf):
    return constraints.constraint_report(read_tables(spark, sf, SPEC), SPEC)


# ---- synthesis --------------------------------------------------------------------


def generate_rows(spark, sf):
    """Orders of every day between the first and the last one, days without orders included."""
    day = F.to_date("o_orderdate")
    daily = _table(spark, sf, "orders").groupBy(day.alias("day")).agg(
        F.count(F.lit(1)).alias("orders"), F.max("o_totalprice").alias("highest")
    )
    first, days = daily.agg(F.min("day"), F.date_diff(F.max("day"), F.min("day")) + 1).first()
    every = synthesis.generate_rows(spark, days or 0, "number")
    every = every.withColumn("day", F.date_add(F.lit(first), F.col("number").cast("int") - 1))
    counted = every.join(daily, "day", "left")
    return counted.select(
        "number",
        F.col("day").cast("string").alias("day"),
        F.coalesce("orders", F.lit(0)).alias("orders"),
        "highest",
        draw_between(1, 6, "lot", "number").alias("lot"),
    )


def value_rules(spark, sf):
    def value(name, **args):
        return rule_column(RuleContext(name, ("o_orderkey",), ANCHOR), name, args, {"given_name": PRIORITIES})

    return _table(spark, sf, "orders").select(
        "o_orderkey",
        value("pyint", min_value=3, max_value=17).alias("shelf"),
        value("pydecimal", left_digits=4, right_digits=1).cast("double").alias("drift"),
        value("date_between", start_date="2023-11-05").cast("string").alias("packed"),
        value("date_this_year").cast("string").alias("weighed"),
        value("date_time_this_decade").cast("string").alias("scanned"),
        value("random_element", elements=["dock", "belt", "cage", "van"]).alias("place"),
        value("given_name").alias("priority"),
        value("sha256").alias("seal"),
        value("unique.ean", length=9).alias("label"),
    )


def sample_foreign_key(spark, sf):
    pool = synthesis.key_pool(_table(spark, sf, "customer"), "c_custkey")
    orders = _table(spark, sf, "orders").select("o_orderkey")
    return synthesis.sample_foreign_key(orders, "o_orderkey", pool, "customer_key", "fk", 0.1)


def sample_foreign_key_sparse(spark, sf):
    pool = synthesis.key_pool(_table(spark, sf, "part").where("p_size <= 10"), "p_partkey")
    orders = _table(spark, sf, "orders").select("o_orderkey")
    return synthesis.sample_foreign_key(orders, "o_orderkey", pool, "part_key", "sparse")


def inject_nulls(spark, sf):
    return _orders_with_gaps(spark, sf).drop("o_custkey")


def assign_one_to_one(spark, sf):
    return synthesis.assign_one_to_one(_table(spark, sf, "customer"), "c_custkey", "pair", "account_id")


def fan_out(spark, sf):
    orders = _table(spark, sf, "orders").select("o_orderkey")
    copies = synthesis.fan_out(orders, "o_orderkey", 0, 4, "fan")
    return copies.withColumn("weight", draw_between(2, 31, "weight", "o_orderkey", "seq"))


def sample_distinct_links(spark, sf):
    pool = synthesis.key_pool(_table(spark, sf, "part"), "p_partkey")
    orders = _table(spark, sf, "orders").select("o_orderkey")
    links = synthesis.sample_distinct_links(orders, "o_orderkey", pool, "part_key", 0, 5, "links")
    return links.withColumn("quantity", draw_between(1, 5, "quantity", "o_orderkey", "seq"))


def sample_distinct_links_sparse(spark, sf):
    pool = synthesis.key_pool(_table(spark, sf, "supplier").where("s_acctbal > 0"), "s_suppkey")
    parts = _table(spark, sf, "part").select("p_partkey")
    return synthesis.sample_distinct_links(parts, "p_partkey", pool, "supplier_key", 1, 3, "sources").drop("seq")


def self_reference_earlier(spark, sf):
    customers = _table(spark, sf, "customer").select("c_custkey")
    pool = synthesis.key_pool(customers, "c_custkey")
    return synthesis.self_reference_earlier(customers, "c_custkey", pool, "referrer", "boss", 0.1)


def self_reference_earlier_sparse(spark, sf):
    parts = _table(spark, sf, "part").where("p_type = 'ECONOMY'").select("p_partkey")
    pool = synthesis.key_pool(parts, "p_partkey", ordered=True)
    return synthesis.self_reference_earlier(parts, "p_partkey", pool, "variant_of", "variant")


def reference_other(spark, sf):
    customers = _table(spark, sf, "customer").select(
        "c_custkey", F.col("c_nationkey").cast("bigint").alias("partner")
    )
    pool = synthesis.key_pool(customers, "c_custkey")
    return synthesis.reference_other(customers, "c_custkey", pool, "partner", "partner", 0.3)


def update_reference(spark, sf):
    pool = synthesis.key_pool(_table(spark, sf, "supplier"), "s_suppkey")
    parts = _table(spark, sf, "part").select("p_partkey", F.lit(None).cast("bigint").alias("supplier_key"))
    return synthesis.update_reference(parts, "p_partkey", pool, "supplier_key", "restock", 0.2)


def decimal_to_double(spark, sf):
    ctx = RuleContext("money", ("o_orderkey",), ANCHOR)
    orders = _table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    drawn = orders.withColumn("discount", rule_column(ctx, "pydecimal", {"left_digits": 2, "right_digits": 2}))
    exact = drawn.withColumn("o_totalprice", F.col("o_totalprice").cast("decimal(12,2)"))
    return synthesis.decimals_to_double(exact)


def mail_spec() -> dict:
    """Tables that hang on customers, orders and parts: a weekly slot, parcels and leaflets."""

    def column(name, kind, parent=None):
        return {"name": name, "type": kind} | ({"foreign_key": parent} if parent else {})

    slots = {
        "name": "slots",
        "columns": [
            column("slot", "INTEGER PRIMARY KEY"),
            column("customer_key", "INTEGER UNIQUE", "customer(c_custkey)"),
            column("weekday", "TEXT CHECK(weekday <> 'sunday')"),
        ],
        "populate": {
            "map_source": {"source_table": "customer", "source_column": "c_custkey"},
            "data": [
                {"column": "customer_key", "is_source_id": True},
                {"column": "weekday", "faker_provider": "random_element", "args": {"elements": WEEKDAYS}},
            ],
        },
    }
    parcels = {
        "name": "parcels",
        "columns": [
            column("parcel", "INTEGER PRIMARY KEY"),
            column("order_key", "INTEGER NOT NULL", "orders(o_orderkey)"),
            column("grams", "INTEGER CHECK(grams >= 70)"),
        ],
        "populate": {
            "count_per_source": {"source_table": "orders", "source_column": "o_orderkey", "min": 0, "max": 2},
            "data": [
                {"column": "order_key", "is_source_id": True},
                {"column": "grams", "faker_provider": "pyint", "args": {"min_value": 70, "max_value": 2300}},
            ],
        },
    }
    leaflets = {
        "name": "leaflets",
        "columns": [
            column("customer_key", "INTEGER", "customer(c_custkey)"),
            column("part_key", "INTEGER", "part(p_partkey)"),
        ],
        "primary_key": ["customer_key", "part_key"],
        "populate": {
            "count_per_source": {"source_table": "customer", "source_column": "c_custkey", "min": 2, "max": 7},
            "data": [
                {"column": "customer_key", "is_source_id": True},
                {
                    "column": "part_key",
                    "faker_provider": "random_element",
                    "source_table": "part",
                    "source_column": "p_partkey",
                },
            ],
        },
    }
    return {"tables": [slots, parcels, leaflets]}


def synth_report(spark, sf):
    given = read_tables(spark, sf, ["customer", "orders", "part"])
    spec = mail_spec()
    filled = fill_tables(spark, spec, new_path(spark, "mail"), "mail", ANCHOR, existing=given)
    report = constraints.constraint_report(given | filled, constraint_spec(spec))
    parts = [
        filled["slots"].selectExpr("'slots' AS table_name", "slot AS row_id", "customer_key AS parent", "weekday AS detail"),
        filled["parcels"].selectExpr("'parcels'", "parcel", "order_key", "cast(grams AS string)"),
        filled["leaflets"].selectExpr("'leaflets'", "part_key", "customer_key", "cast(NULL AS string)"),
        report.selectExpr("'constraints'", "count(1)", "sum(violations)", "cast(NULL AS string)"),
    ]
    return reduce(DataFrame.union, parts)


def _llm():
    """The queries of the training-data operators, or None where that subpackage is absent."""
    try:
        found = importlib.util.find_spec("tablekin.llm.queries")
    except ModuleNotFoundError:
        found = None
    if found is None:
        return None
    from tablekin.llm import queries as llm

    return llm


def _with_workers(query: Query) -> Query:
    """Let Python workers find this repository, wherever the session was started."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        here = os.path.dirname(os.path.abspath(__file__))
        known = spark.sparkContext.environment.get("PYTHONPATH", "")
        if here not in known.split(os.pathsep):
            spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [here, known]))
        return query(spark, folder)

    return run


def entry(spark: SparkSession) -> DataFrame:
    """The parent/child report on the smallest tables."""
    return parent_child_report(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Query]:
    llm = _llm()
    added = {name: _with_workers(query) for name, query in llm.QUERIES.items()} if llm else {}
    return TABLE_QUERIES | added


TABLE_QUERIES: dict[str, Query] = {
    "adhoc_sql": adhoc_sql,
    "inline_rows": inline_join,
    "table_sink": table_sink,
    "description_sink": description_sink,
    "project_alias": project_alias,
    "concat_name": concat_name,
    "filter_not_like": filter_not_like,
    "join_inner": join_inner,
    "join_left": join_left,
    "join_same_name": join_same_name,
    "join_left_skewed": join_left_skewed,
    "count_per_parent": count_per_parent,
    "random_top_k": random_top_k,
    "limit_k": limit_k,
    "parent_child_report": parent_child_report,
    "keyed_update": keyed_update,
    "merge_table": merge_table,
    "shuffle_rank": shuffle_rank,
    "shuffle_rank_sparse": shuffle_rank_sparse,
    "insert_or_ignore": insert_or_ignore,
    "catalog_tables": catalog_tables,
    "catalog_columns": catalog_columns,
    "primary_keys": primary_keys,
    "foreign_keys": foreign_keys,
    "relationships": relationships,
    "column_profile": column_profile,
    "key_candidates": key_candidates,
    "discovered_relationships": discovered_relationships,
    "observed_relationships": observed_relationships,
    "check_not_null": check_not_null,
    "check_unique": check_unique,
    "check_primary_key": check_primary_key,
    "check_expr": check_expr,
    "check_foreign_key": check_foreign_key,
    "apply_default": apply_default,
    "constraint_report": constraint_report,
    "generate_rows": generate_rows,
    "value_rules": value_rules,
    "sample_foreign_key": sample_foreign_key,
    "sample_foreign_key_sparse": sample_foreign_key_sparse,
    "inject_nulls": inject_nulls,
    "assign_one_to_one": assign_one_to_one,
    "fan_out": fan_out,
    "sample_distinct_links": sample_distinct_links,
    "sample_distinct_links_sparse": sample_distinct_links_sparse,
    "self_reference_earlier": self_reference_earlier,
    "self_reference_earlier_sparse": self_reference_earlier_sparse,
    "reference_other": reference_other,
    "update_reference": update_reference,
    "decimal_to_double": decimal_to_double,
    "synth_report": synth_report,
}


def oracle_sql() -> dict[str, str]:
    from twins import twin_queries

    llm = _llm()
    return twin_queries(TABLES) | (llm.oracles() if llm else {})
