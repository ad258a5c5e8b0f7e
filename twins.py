"""The SQL twin of every query, for DuckDB over the same parquet tables."""

from __future__ import annotations


def text(seed: str, *keys: str) -> str:
    return " || '|' || ".join([f"'{seed}'", *[f"cast({k} as varchar)" for k in keys]])


def draw(seed: str, *keys: str) -> str:
    return f"cast('0x' || substr(md5({text(seed, *keys)}), 1, 15) as bigint)"


def below(limit: str | int, seed: str, *keys: str) -> str:
    return f"({draw(seed, *keys)} % {limit})"


def between(low: int, high: int, seed: str, *keys: str) -> str:
    return f"({low} + {below(high - low + 1, seed, *keys)})"


def kept(share: float, seed: str, *keys: str) -> str:
    return f"({below(1_000_000, seed, *keys)} >= {round(share * 1_000_000)})"


def shuffled(seed: str, key: str) -> str:
    return f"md5({text(seed, key)}), {key}"


GAPS = f"""SELECT o_orderkey, o_custkey,
  CASE WHEN {kept(0.25, 'gaps', 'o_orderkey')} THEN o_orderpriority END AS o_orderpriority FROM orders"""

# (child, columns, parent, columns) of the declared references.
LINKS = [
    ("nation", "n_regionkey", "region", "r_regionkey"),
    ("customer", "c_nationkey", "nation", "n_nationkey"),
    ("supplier", "s_nationkey", "nation", "n_nationkey"),
    ("orders", "o_custkey", "customer", "c_custkey"),
    ("lineitem", "l_orderkey", "orders", "o_orderkey"),
    ("lineitem", "l_partkey", "part", "p_partkey"),
    ("lineitem", "l_suppkey", "supplier", "s_suppkey"),
    ("labels", "doc_id", "documents", "doc_id"),
]
PRIMARY_KEYS = {
    "region": ["r_regionkey"],
    "nation": ["n_nationkey"],
    "customer": ["c_custkey"],
    "supplier": ["s_suppkey"],
    "part": ["p_partkey"],
    "orders": ["o_orderkey"],
    "lineitem": ["l_orderkey", "l_linenumber"],
    "documents": ["doc_id"],
    "labels": ["doc_id"],
    "conversations": ["conv_id", "turn"],
}
UNIQUE = [("region", "r_name"), ("nation", "n_name"), ("customer", "c_name"), ("documents", "text")]
NOT_NULL = [
    ("region", "r_name"),
    ("customer", "c_name"),
    ("orders", "o_custkey"),
    ("orders", "o_orderdate"),
    ("lineitem", "l_quantity"),
]
CHECKS = [
    ("part", "size", "p_size BETWEEN 1 AND 40"),
    ("orders", "status", "o_orderstatus IN ('F', 'O', 'P')"),
    ("orders", "price", "o_totalprice <= 400000"),
    ("lineitem", "discount", "l_discount <= 0.05"),
]
# Links found by name, and the two given by hand.
FOUND = [
    *LINKS,
    ("documents", "doc_id", "labels", "doc_id"),
    ("events", "user_id", "customer", "c_custkey"),
    ("part", "p_size", "nation", "n_nationkey"),
]


def union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


def link_facts(links: list[tuple[str, str, str, str]]) -> str:
    return union(
        [
            f"""SELECT '{child}' AS from_table, '{parent}' AS to_table, '{c} -> {p}' AS link,
  count({c}) AS child_rows, count(DISTINCT {c}) AS child_keys,
  count(DISTINCT CASE WHEN NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{p} = t.{c}) THEN {c} END) AS orphan_keys,
  CASE WHEN count({c}) = count(DISTINCT {c}) THEN 'one-to-one' ELSE 'one-to-many' END AS observed
FROM {child} t"""
            for child, c, parent, p in links
        ]
    )


def report() -> str:
    parts = [
        f"SELECT '{t}' AS table_name, 'not_null({c})' AS constraint_name, count(*) - count({c}) AS violations FROM {t}"
        for t, c in NOT_NULL
    ]
    parts += [f"SELECT '{t}', 'check({n})', count(*) FILTER (WHERE NOT ({e})) FROM {t}" for t, n, e in CHECKS]
    for table, columns in PRIMARY_KEYS.items():
        names = ", ".join(columns)
        parts.append(
            f"""SELECT '{table}', 'primary_key({names})', count(*) FROM
(SELECT {names} FROM {table} GROUP BY {names} HAVING count(*) > 1)"""
        )
    parts += [
        f"""SELECT '{t}', 'unique({c})', count(*) FROM
(SELECT {c} FROM {t} WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1)"""
        for t, c in UNIQUE
    ]
    parts += [
        f"""SELECT '{t}', 'foreign_key({c} -> {parent}.{p})', count(*) FROM {t}
WHERE {c} IS NOT NULL AND {c} NOT IN (SELECT {p} FROM {parent})"""
        for t, c, parent, p in LINKS
    ]
    return union(parts)


def documents(tables: dict) -> str:
    """Per table the description as JSON text, in the key order of the sink."""
    parts = []
    for table, columns in sorted(tables.items()):
        required = [c for t, c in NOT_NULL if t == table]
        listed = ",".join(
            f'{{"name":"{n}","type":"{t}","nullable":{"false" if n in required else "true"}}}' for n, t in columns
        )
        key = ",".join(f'"{c}"' for c in PRIMARY_KEYS.get(table, []))
        references = ",".join(
            f'{{"to_table":"{parent}","from_columns":["{c}"],"to_columns":["{p}"]}}'
            for child, c, parent, p in LINKS
            if child == table
        )
        tail = f'"columns":[{listed}],"primary_key":[{key}],"foreign_keys":[{references}]}}'
        parts.append(
            f"""SELECT '{{"table_name":"{table}","row_count":' || count(*) || ',{tail}' AS document FROM {table}"""
        )
    return union(parts)


def walk(start: str, seed: str, keyed: bool) -> str:
    """CTEs ending in ``places(key, i, place)`` for ``start`` (key, i, n): the keyed permutation round by round."""
    parts = ["cast(key as varchar)", "'|'"] if keyed else []

    def drawn(digit: str) -> str:
        text = " || ".join([f"'{seed}|'", "(r % rounds)", "'|'", *parts, f"cast({digit} as varchar)"])
        return f"cast('0x' || substr(md5({text}), 1, 15) as bigint)"

    return f"""started AS (SELECT *, cast(floor(sqrt(greatest(n - 1, 0))) as bigint) + 1 AS a,
  CASE WHEN n >= 64 THEN 6 ELSE 16 END AS rounds FROM ({start})),
walk AS (
  SELECT key, i, n, a, rounds, (n + a - 1) // a AS b, i % a AS x, i // a AS y, 0 AS r FROM started
  UNION ALL
  SELECT key, i, n, a, rounds, b, CASE WHEN r % 2 = 0 THEN (x + {drawn('y')} % a) % a ELSE x END,
         CASE WHEN r % 2 = 1 THEN (y + {drawn('x')} % b) % b ELSE y END, r + 1
  FROM walk WHERE r = 0 OR r % rounds > 0 OR y * a + x >= n),
places AS (SELECT key, i, y * a + x AS place FROM walk WHERE r > 0 AND r % rounds = 0 AND y * a + x < n)"""


def distinct_links(source: str, key: str, pool_size: str, low: int, high: int, seed: str) -> str:
    """CTEs ending in ``places(key, i, place)``: the first places of a permutation per source row."""
    k = f"least({between(low, high, f'{seed}|k', key)}, {pool_size})"
    return walk(f"SELECT {key} AS key, unnest(range({k})) AS i, {pool_size} AS n FROM {source}", seed, True)


def keys(tables: dict[str, list[tuple[str, str]]]) -> str:
    """Every minimal key of one or two columns, each set counted by itself."""
    parts = []
    for t, columns in tables.items():
        names = [c for c, kind in columns if kind not in ("double", "float")]
        sets = [(c,) for c in names] + [(a, b) for i, a in enumerate(names) for b in names[i + 1 :]]
        for s in sets:
            present = " AND ".join(f"{c} IS NOT NULL" for c in s)
            parts.append(
                f"""SELECT '{t}' AS table_name, '{', '.join(s)}' AS key_columns, {len(s)} AS width, count(*) AS row_count,
  count(*) FILTER (WHERE {present}) AS present, count(DISTINCT ({', '.join(s)})) FILTER (WHERE {present}) AS distinct_count FROM {t}"""
            )
    return f"""WITH sets AS ({union(parts)}),
found AS (SELECT * FROM sets WHERE row_count > 0 AND present = row_count AND distinct_count = row_count)
SELECT table_name, key_columns, row_count, distinct_count FROM found f WHERE width = 1 OR NOT EXISTS (
  SELECT 1 FROM found g WHERE g.table_name = f.table_name AND g.width = 1
  AND list_contains(string_split(f.key_columns, ', '), g.key_columns))"""


def twin_queries(tables: dict[str, list[tuple[str, str]]]) -> dict[str, str]:
    leaflets = distinct_links("customer", "c_custkey", "(SELECT count(*) FROM part)", 2, 7, "mail|leaflets.part_key")
    return {
        "adhoc_sql": """SELECT c_mktsegment AS segment, count(*) AS orders, min(o_totalprice) AS cheapest
FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderstatus = 'F' GROUP BY c_mktsegment""",
        "inline_rows": """SELECT id, code, meaning, weight, (SELECT count(*) FROM orders WHERE o_orderstatus = code) AS orders
FROM (VALUES (cast(1 as bigint), 'F', 'finished', cast(1.0 as double)), (2, 'O', NULL, 2.0), (3, 'X', 'unknown', 1.0))
  v(id, code, meaning, weight)""",
        "table_sink": "SELECT o_orderkey, o_orderstatus, o_custkey FROM orders WHERE o_orderstatus IN ('F', 'P')",
        "description_sink": documents(tables),
        "project_alias": """SELECT l_orderkey AS order_key, l_quantity AS quantity,
  l_extendedprice * (1 - l_discount) AS net_price FROM lineitem""",
        "concat_name": f"""SELECT p_partkey,
  p_brand || ' ' || CASE WHEN {kept(0.2, 'concat', 'p_partkey')} THEN p_type END AS label FROM part""",
        "filter_not_like": "SELECT p_partkey, p_name FROM part WHERE p_type = 'ECONOMY' AND p_name NOT LIKE 'red%'",
        "join_inner": """SELECT o_orderkey, c_name, n_name FROM orders
JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey""",
        "join_left": """SELECT o_orderkey, o_orderstatus, l_orderkey, l_linenumber, l_partkey, l_quantity FROM orders
LEFT JOIN lineitem ON l_orderkey = o_orderkey""",
        "join_same_name": """SELECT doc_id, lang, source, n_chars, quality, toxic FROM documents JOIN labels USING (doc_id)""",
        "join_left_skewed": """WITH g AS (SELECT DISTINCT lang, source FROM documents),
every AS (SELECT * FROM g UNION ALL SELECT lang, source || '-archive' FROM g)
SELECT e.lang, e.source, doc_id, n_chars FROM every e LEFT JOIN documents d ON d.lang = e.lang AND d.source = e.source""",
        "count_per_parent": """SELECT o_orderkey, o_orderstatus, count(l_partkey) AS items
FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey, o_orderstatus""",
        "random_top_k": f"SELECT o_orderkey, o_totalprice FROM orders ORDER BY {shuffled('top', 'o_orderkey')} LIMIT 10",
        "limit_k": "SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderkey LIMIT 10",
        "parent_child_report": f"""SELECT customer, nation, region, order_count FROM (
  SELECT c_custkey, c_name || ' ' || c_mktsegment AS customer, n_name AS nation, r_name AS region,
         count(o_orderkey) AS order_count
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  LEFT JOIN orders ON o_custkey = c_custkey
  GROUP BY c_custkey, c_name, c_mktsegment, n_name, r_name
  ORDER BY {shuffled('report', 'c_custkey')} LIMIT 5)""",
        "keyed_update": """SELECT c_custkey, c_name, CASE WHEN o_custkey IS NULL THEN c_acctbal ELSE highest END AS c_acctbal
FROM customer LEFT JOIN (SELECT o_custkey, max(o_totalprice) AS highest FROM orders
  WHERE o_orderpriority = '1-URGENT' GROUP BY o_custkey) ON o_custkey = c_custkey""",
        "merge_table": """WITH latest AS (SELECT o_custkey + 5 AS k, o_totalprice AS price,
  row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
  FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'P')
SELECT coalesce(c_custkey, k) AS c_custkey, c_name, CASE WHEN k IS NULL THEN c_acctbal ELSE price END AS c_acctbal
FROM customer FULL JOIN (SELECT * FROM latest WHERE rn = 1) ON c_custkey = k""",
        "shuffle_rank": f"""WITH RECURSIVE low AS (SELECT min(o_orderkey) AS low, count(*) AS n FROM orders),
{walk('SELECT o_orderkey AS key, o_orderkey - low AS i, n FROM orders, low', 'mix', False)}
SELECT key AS o_orderkey, place + 1 AS rank FROM places""",
        "shuffle_rank_sparse": f"""SELECT p_partkey, row_number() OVER (ORDER BY {shuffled('blend', 'p_partkey')}) AS rank
FROM part WHERE p_size > 10""",
        "insert_or_ignore": """SELECT o_orderkey AS order_key, cast(1 + o_custkey % 7 as integer) AS line, cast(NULL as bigint) AS part_key,
  cast(NULL as bigint) AS supplier_key FROM orders WHERE o_orderstatus = 'F'
UNION ALL
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey) AS rn
  FROM lineitem) WHERE rn = 1 AND NOT EXISTS (SELECT 1 FROM orders
  WHERE o_orderstatus = 'F' AND o_orderkey = l_orderkey AND 1 + o_custkey % 7 = l_linenumber)""",
        "catalog_tables": union([f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in tables]),
        "catalog_columns": union(
            [
                f"""SELECT '{t}' AS table_name, '{c}' AS column_name, {i} AS position, '{kind}' AS data_type,
  {'false' if (t, c) in NOT_NULL else 'true'} AS nullable, count(*) - count({c}) AS null_count FROM {t}"""
                for t, columns in tables.items()
                for i, (c, kind) in enumerate(columns, 1)
            ]
        ),
        "primary_keys": union(
            [
                f"""SELECT '{t}' AS table_name, '{', '.join(cs)}' AS key_columns,
  cast(sum(n) as bigint) AS row_count, count(*) AS key_count
FROM (SELECT count(*) AS n FROM {t} GROUP BY {', '.join(cs)})"""
                for t, cs in PRIMARY_KEYS.items()
            ]
        ),
        "foreign_keys": f"""SELECT from_table, to_table, split_part(link, ' -> ', 1) AS from_columns,
  split_part(link, ' -> ', 2) AS to_columns, child_rows, orphan_keys FROM ({link_facts(LINKS)})""",
        "relationships": f"""SELECT from_table, to_table, link,
  CASE WHEN from_table = 'labels' THEN 'one-to-one' ELSE 'one-to-many' END AS declared_type,
  observed AS observed_type FROM ({link_facts(LINKS)})""",
        "column_profile": union(
            [
                f"""SELECT '{t}' AS table_name, '{c}' AS column_name, count(*) AS row_count,
  count(*) - count({c}) AS null_count, count({c}) = count(DISTINCT {c}) AS is_unique,
  count(DISTINCT {c}) AS distinct_count FROM {t}"""
                for t, columns in tables.items()
                for c, _ in columns
            ]
        ),
        "key_candidates": keys(tables),
        "discovered_relationships": f"""SELECT from_table, to_table, link, child_rows, child_keys, orphan_keys, observed AS type
FROM ({link_facts(LINKS)}) WHERE orphan_keys = 0""",
        "observed_relationships": f"""SELECT from_table, to_table, link, child_rows, child_keys, orphan_keys,
  orphan_keys = 0 AS contained, observed AS type FROM ({link_facts(FOUND)})""",
        "check_not_null": f"SELECT * FROM ({GAPS}) WHERE o_orderpriority IS NULL",
        "check_unique": f"""SELECT o_custkey, o_orderpriority, count(*) AS row_count FROM ({GAPS})
WHERE o_orderpriority IS NOT NULL GROUP BY o_custkey, o_orderpriority HAVING count(*) > 1""",
        "check_primary_key": f"""SELECT o_custkey, o_orderpriority, count(*) AS row_count FROM ({GAPS})
GROUP BY o_custkey, o_orderpriority HAVING count(*) > 1 OR o_orderpriority IS NULL""",
        "check_expr": """SELECT l_orderkey, l_linenumber, l_discount FROM lineitem
WHERE NOT (l_discount <= 0.05 OR l_linenumber = 1)""",
        "check_foreign_key": """SELECT l_partkey, count(*) AS row_count FROM lineitem
WHERE NOT EXISTS (SELECT 1 FROM part WHERE p_partkey = l_partkey AND p_size <= 40) GROUP BY l_partkey""",
        "apply_default": f"SELECT o_orderkey, o_orderpriority, 'web' AS channel FROM ({GAPS})",
        "constraint_report": report(),
        "generate_rows": f"""WITH span AS (SELECT min(o_orderdate)::date AS first, max(o_orderdate)::date - min(o_orderdate)::date + 1 AS days
  FROM orders)
SELECT number, cast(first + cast(number - 1 as integer) as varchar) AS day, count(o_orderkey) AS orders,
  max(o_totalprice) AS highest, {between(1, 6, 'lot', 'number')} AS lot
FROM (SELECT first, unnest(range(1, days + 1)) AS number FROM span)
LEFT JOIN orders ON o_orderdate::date = first + cast(number - 1 as integer) GROUP BY number, first""",
        "value_rules": f"""SELECT o_orderkey, {between(3, 17, 'pyint', 'o_orderkey')} AS shelf,
  ({below(199999, 'pydecimal', 'o_orderkey')} - 99999) / 10.0::double AS drift,
  cast(date '2023-11-05' + cast({below(89, 'date_between', 'o_orderkey')} as integer) as varchar) AS packed,
  cast(date '2024-01-01' + cast({below(32, 'date_this_year', 'o_orderkey')} as integer) as varchar) AS weighed,
  cast(timestamp '2020-01-01 00:00:00' + to_seconds({below(128952001, 'date_time_this_decade', 'o_orderkey')}) as varchar) AS scanned,
  (['dock', 'belt', 'cage', 'van'])[1 + {below(4, 'random_element', 'o_orderkey')}] AS place,
  (['low', 'medium', 'high'])[1 + {below(3, 'given_name', 'o_orderkey')}] AS priority,
  sha256({text('sha256', 'o_orderkey')}) AS seal, lpad(cast(o_orderkey as varchar), 9, '0') AS label FROM orders""",
        "sample_foreign_key": f"""SELECT o_orderkey, CASE WHEN {kept(0.1, 'fk|null', 'o_orderkey')} THEN
  (SELECT min(c_custkey) FROM customer) + {below('(SELECT count(*) FROM customer)', 'fk', 'o_orderkey')} END AS customer_key
FROM orders""",
        "sample_foreign_key_sparse": f"""WITH pool AS (
  SELECT p_partkey, row_number() OVER (ORDER BY {shuffled('pool', 'p_partkey')}) - 1 AS i FROM part WHERE p_size <= 10)
SELECT o_orderkey, p_partkey AS part_key FROM orders
JOIN pool ON i = {below('(SELECT count(*) FROM pool)', 'sparse', 'o_orderkey')}""",
        "inject_nulls": f"SELECT o_orderkey, o_orderpriority FROM ({GAPS})",
        "assign_one_to_one": f"""WITH RECURSIVE low AS (SELECT min(c_custkey) AS low, count(*) AS n FROM customer),
{walk('SELECT c_custkey AS key, c_custkey - low AS i, n FROM customer, low', 'pair', False)}
SELECT place + 1 AS account_id, key AS c_custkey FROM places""",
        "fan_out": f"""SELECT o_orderkey, seq, {between(2, 31, 'weight', 'o_orderkey', 'seq')} AS weight FROM (
  SELECT o_orderkey, unnest(range(1, {between(0, 4, 'fan', 'o_orderkey')} + 1)) AS seq FROM orders)""",
        "sample_distinct_links": f"""WITH RECURSIVE {distinct_links(
            'orders', 'o_orderkey', '(SELECT count(*) FROM part)', 0, 5, 'links')}
SELECT key AS o_orderkey, i + 1 AS seq, (SELECT min(p_partkey) FROM part) + place AS part_key,
  {between(1, 5, 'quantity', 'key', '(i + 1)')} AS quantity FROM places""",
        "sample_distinct_links_sparse": f"""WITH RECURSIVE pool AS (
  SELECT s_suppkey, row_number() OVER (ORDER BY {shuffled('pool', 's_suppkey')}) - 1 AS spot FROM supplier WHERE s_acctbal > 0),
{distinct_links('part', 'p_partkey', '(SELECT count(*) FROM pool)', 1, 3, 'sources')}
SELECT key AS p_partkey, s_suppkey AS supplier_key FROM places JOIN pool ON spot = place""",
        "self_reference_earlier": f"""WITH placed AS (
  SELECT c_custkey, row_number() OVER (ORDER BY c_custkey) - 1 AS place FROM customer)
SELECT a.c_custkey, b.c_custkey AS referrer FROM placed a LEFT JOIN placed b
  ON a.place > 0 AND {kept(0.1, 'boss|null', 'a.c_custkey')}
 AND b.place = {below('greatest(a.place, 1)', 'boss', 'a.c_custkey')}""",
        "self_reference_earlier_sparse": f"""WITH placed AS (
  SELECT p_partkey, row_number() OVER (ORDER BY p_partkey) - 1 AS place FROM part WHERE p_type = 'ECONOMY')
SELECT a.p_partkey, b.p_partkey AS variant_of FROM placed a LEFT JOIN placed b
  ON a.place > 0 AND b.place = {below('greatest(a.place, 1)', 'variant', 'a.p_partkey')}""",
        "reference_other": f"""WITH placed AS (
  SELECT c_custkey, c_nationkey, row_number() OVER (ORDER BY c_custkey) - 1 AS place, count(*) OVER () AS n FROM customer)
SELECT a.c_custkey, CASE WHEN {kept(0.3, 'partner|null', 'a.c_custkey')} THEN b.c_custkey
  ELSE cast(a.c_nationkey as bigint) END AS partner
FROM placed a JOIN placed b ON b.place = (a.place + 1 + {below('(a.n - 1)', 'partner', 'a.c_custkey')}) % a.n""",
        "update_reference": f"""SELECT p_partkey, CASE WHEN {kept(0.2, 'restock|null', 'p_partkey')} THEN
  (SELECT min(s_suppkey) FROM supplier) + {below('(SELECT count(*) FROM supplier)', 'restock', 'p_partkey')} END AS supplier_key
FROM part""",
        "decimal_to_double": f"""SELECT o_orderkey, cast(cast(o_totalprice as decimal(12,2)) as double) AS o_totalprice,
  ({below(19999, 'money', 'o_orderkey')} - 9999) / 100.0::double AS discount FROM orders""",
        "synth_report": f"""WITH RECURSIVE low AS (SELECT min(c_custkey) AS low, count(*) AS n FROM customer),
{walk('SELECT c_custkey AS key, c_custkey - low AS i, n FROM customer, low', 'mail|slots.map_source', False)},
slots AS (SELECT place + 1 AS slot, key AS customer_key FROM places),
shares AS (SELECT o_orderkey, unnest(range(1, {between(0, 2, 'mail|parcels.count_per_source', 'o_orderkey')} + 1)) AS seq FROM orders),
{leaflets.replace('started', 'started2').replace('walk', 'walk2').replace('places', 'places2')}
SELECT 'slots' AS table_name, slot AS row_id, customer_key AS parent,
  (['monday', 'wednesday', 'thursday', 'saturday'])[1 + {below(4, 'mail|slots.weekday', 'slot')}] AS detail FROM slots
UNION ALL SELECT 'parcels', row_number() OVER (ORDER BY o_orderkey, seq), o_orderkey,
  cast({between(70, 2300, 'mail|parcels.grams', 'o_orderkey', 'seq')} as varchar) FROM shares
UNION ALL SELECT 'leaflets', (SELECT min(p_partkey) FROM part) + place, key, NULL FROM places2
UNION ALL SELECT 'constraints', 11, 0, NULL""",
    }
