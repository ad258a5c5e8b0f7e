from collections import Counter
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tablekin.operators import synthesis
from tablekin.plans.constraints import constraint_report
from tablekin.plans.declarations import DefaultExpression, constraint_spec, read_column, read_tables
from tablekin.plans.filling import fill_tables

ANCHOR = datetime(2024, 3, 10, 8, 0)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def fill(spark, spec, path, seed=1, lists=None):
    return fill_tables(spark, spec, str(path), seed, ANCHOR, lists)


def gauge_spec(stations, surveys):
    """A river gauge network that uses every fill mode."""

    def made(name, columns, populate, **more):
        listed = [{"name": n, "type": t} | ({"foreign_key": fk[0]} if fk else {}) for n, t, *fk in columns]
        return {"name": name, "columns": listed, "populate": populate, **more}

    def pick(column, table, **more):
        return {"column": column, "faker_provider": "random_element", "source_table": table, **more}

    number = "INTEGER PRIMARY KEY"
    return {
        "tables": [
            made(
                "river",
                [("river_no", number), ("name", "TEXT UNIQUE NOT NULL"), ("mouth", "INTEGER", "river(river_no)")],
                {
                    "source_data": [{"name": "Aa"}, {"name": "Bode"}, {"name": "Cam"}, {"name": "Dee"}],
                    "post_populate": [pick("mouth", "river", allow_null=0.4)],
                },
            ),
            made(
                "station",
                [
                    ("station_no", number),
                    ("river_no", "INTEGER", "river"),
                    ("upstream", "INTEGER", "station(station_no)"),
                    ("level", "REAL CHECK(level >= 0)"),
                ],
                {
                    "count": stations,
                    "data": [
                        pick("river_no", "river"),
                        pick("upstream", "station", allow_null=0.25),
                        {
                            "column": "level",
                            "faker_provider": "pydecimal",
                            "args": {"left_digits": 1, "right_digits": 3, "positive": True},
                        },
                    ],
                },
            ),
            made(
                "keeper",
                [("keeper_no", number), ("station_no", "INTEGER UNIQUE", "station"), ("seal", "TEXT NOT NULL")],
                {
                    "map_source": {"source_table": "station"},
                    "data": [{"column": "station_no", "is_source_id": True}, {"column": "seal", "faker_provider": "sha256"}],
                },
            ),
            made(
                "reading",
                [("reading_no", number), ("station_no", "INTEGER NOT NULL", "station(station_no)"), ("taken", "DATETIME")],
                {
                    "count_per_source": {"source_table": "station", "min": 2, "max": 6},
                    "data": [
                        {"column": "station_no", "is_source_id": True},
                        {"column": "taken", "faker_provider": "date_time_this_month"},
                    ],
                },
            ),
            made(
                "survey",
                [("survey_no", number), ("station_no", "INTEGER", "station"), ("begun", "DATE")],
                {
                    "count": surveys,
                    "data": [
                        pick("station_no", "station"),
                        {"column": "begun", "faker_provider": "date_between", "args": {"start_date": "-8w"}},
                    ],
                },
            ),
            made(
                "visit",
                [
                    ("survey_no", "INTEGER", "survey(survey_no)"),
                    ("station_no", "INTEGER", "station(station_no)"),
                    ("grade", "INTEGER CHECK(grade BETWEEN 1 AND 3)"),
                    ("open", "INTEGER NOT NULL DEFAULT 7"),
                ],
                {
                    "count_per_source": {"source_table": "survey", "min": 0, "max": 3},
                    "data": [
                        {"column": "survey_no", "is_source_id": True},
                        pick("station_no", "station"),
                        {"column": "grade", "faker_provider": "pyint", "args": {"min_value": 1, "max_value": 3}},
                    ],
                },
                primary_key=["survey_no", "station_no"],
            ),
        ]
    }


@pytest.fixture(scope="module")
def gauges(spark, tmp_path_factory):
    spec = gauge_spec(300, 700)
    return spec, fill(spark, spec, tmp_path_factory.mktemp("gauges"))


def test_column_declarations():
    c = read_column({"name": "n", "type": "INTEGER NOT NULL DEFAULT 0"})
    assert (c.not_null, c.default, c.data_type.simpleString(), c.primary_key) == (True, 0, "bigint", False)
    c = read_column({"name": "s", "type": "TEXT(2) CHECK(s IN ('NOT NULL', 'b (c)')) DEFAULT 'it''s'"})
    assert (c.check, c.default, c.not_null) == ("s IN ('NOT NULL', 'b (c)')", "it's", False)
    c = read_column({"name": "k", "type": "INTEGER UNIQUE", "foreign_key": "p(a, b) ON DELETE CASCADE"})
    assert (c.unique, c.reference) == (True, ("p", ["a", "b"]))
    assert read_column({"name": "k", "type": "INTEGER", "foreign_key": "p"}).reference == ("p", [])
    assert read_column({"name": "d", "type": "DATETIME"}).data_type.simpleString() == "timestamp_ntz"
    with pytest.raises(ValueError, match="no known type"):
        read_column({"name": "b", "type": "GEOMETRY"})


@pytest.mark.parametrize(
    ("text", "kind"),
    [
        ("VARCHAR(30) NOT NULL", "string"),
        ("numeric(9, 2)", "decimal(9,2)"),
        ("DECIMAL(4)", "decimal(4,0)"),
        ("DECIMAL", "decimal(18,0)"),
        ("boolean default true", "boolean"),
        ("BIGINT", "bigint"),
        ("TIMESTAMP", "timestamp_ntz"),
        ("DOUBLE PRECISION", "double"),
        ("BLOB", "binary"),
    ],
)
def test_column_types(text, kind):
    assert read_column({"name": "c", "type": text}).data_type.simpleString() == kind


def test_checks_and_default_expressions():
    c = read_column({"name": "n", "type": "INTEGER CHECK((n > 0) OR n IN (-1, -2)) DEFAULT (1 + (2 * 3)) NOT NULL"})
    assert (c.check, c.default, c.not_null) == ("(n > 0) OR n IN (-1, -2)", DefaultExpression("1 + (2 * 3)"), True)
    c = read_column({"name": "t", "type": "TEXT DEFAULT 'a)' CHECK(t <> '(')"})
    assert (c.check, c.default) == ("t <> '('", "a)")
    assert read_column({"name": "t", "type": "DATETIME DEFAULT CURRENT_TIMESTAMP"}).default == DefaultExpression("CURRENT_TIMESTAMP")
    assert read_column({"name": "t", "type": "REAL DEFAULT -1.5e3"}).default == -1500.0
    assert read_column({"name": "t", "type": "BOOLEAN DEFAULT false"}).default is False


def test_defaults_are_computed_at_the_anchor(spark, tmp_path):
    columns = {
        "id": "INTEGER PRIMARY KEY",
        "made": "DATETIME DEFAULT CURRENT_TIMESTAMP",
        "day": "DATE DEFAULT (date_add(current_date, 2))",
        "word": "TEXT DEFAULT (upper('current_date'))",
        "ok": "BOOLEAN DEFAULT TRUE",
    }
    counted = table("a", columns, {"count": 2, "data": []})
    written = table("b", columns, {"source_data": [{"word": "x"}, {"made": None}]})
    got = fill(spark, {"tables": [counted, written]}, tmp_path)
    day = datetime(2024, 3, 12).date()
    assert rows(got["a"]) == [(k, ANCHOR, day, "CURRENT_DATE", True) for k in (1, 2)]
    assert rows(got["b"]) == [(1, ANCHOR, day, "x", True), (2, None, day, "CURRENT_DATE", True)]


def test_surrogate_and_table_keys():
    tables = {t.name: t for t in read_tables(gauge_spec(1, 1))}
    assert tables["river"].surrogate == "river_no" and tables["river"].primary_key == ["river_no"]
    assert tables["visit"].surrogate is None
    assert tables["visit"].primary_key == ["survey_no", "station_no"]


def test_all_constraints_hold(spark, gauges):
    spec, tables = gauges
    report = constraint_report(tables, constraint_spec(spec)).collect()
    assert len(report) == 22 and {r["violations"] for r in report} == {0}


def test_sizes_and_numbering(gauges):
    _, tables = gauges
    sizes = {n: tables[n].count() for n in ("river", "station", "keeper", "survey")}
    assert sizes == {"river": 4, "station": 300, "keeper": 300, "survey": 700}
    readings = tables["reading"].collect()
    assert sorted(r["reading_no"] for r in readings) == list(range(1, len(readings) + 1))
    per = Counter(r["station_no"] for r in readings)
    assert set(per) == set(range(1, 301)) and set(per.values()) == {2, 3, 4, 5, 6}


def test_values_are_their_own(gauges):
    _, tables = gauges
    visits = tables["visit"].collect()
    assert {r["grade"] for r in visits} == {1, 2, 3} and {r["open"] for r in visits} == {7}
    assert len({r["seal"] for r in tables["keeper"].collect()}) == 300
    rivers = tables["river"].collect()
    assert all(r["mouth"] != r["river_no"] for r in rivers)
    assert [r["name"] for r in sorted(rivers)] == ["Aa", "Bode", "Cam", "Dee"]
    upstream = tables["station"].select("station_no", "upstream").collect()
    assert all(r["upstream"] is None or r["upstream"] < r["station_no"] for r in upstream)
    assert max(r["taken"] for r in tables["reading"].collect()) <= ANCHOR


def test_a_fill_is_repeatable_and_seeded(spark, gauges, tmp_path):
    spec, first = gauges
    parallel = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "3")
        again = fill(spark, spec, tmp_path / "again")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", parallel)
    for name in first:
        assert rows(first[name]) == rows(again[name]), name
    other = fill(spark, spec, tmp_path / "other", seed=2)
    assert rows(other["survey"]) != rows(first["survey"])


def test_overwrite_and_append(spark, tmp_path):
    spec = gauge_spec(20, 30)
    fill(spark, spec, tmp_path)
    assert fill(spark, spec, tmp_path)["station"].count() == 20
    more = fill(spark, {**spec, "overwrite": False}, tmp_path)
    assert sorted(r["station_no"] for r in more["station"].collect()) == list(range(1, 41))
    assert sorted(r["station_no"] for r in more["keeper"].collect()) == list(range(1, 41))
    new = more["survey"].where("survey_no > 30")
    assert new.count() == 30 and new.where("station_no <= 20").count() == 0
    report = {(r[0], r[1]): r[2] for r in constraint_report(more, constraint_spec(spec)).collect()}
    broken = {k for k, v in report.items() if v}
    assert broken == {("river", "unique(name)")}  # the literal rows come twice


def test_a_fill_refers_to_existing_tables(spark, tmp_path):
    doors = spark.createDataFrame([(7, "x"), (9, "y"), (12, None)], "door long, colour string")
    spec = {
        "tables": [
            table(
                "bell",
                {"id": "INTEGER PRIMARY KEY", "door": "INTEGER UNIQUE", "colour": "TEXT"},
                {
                    "map_source": {"source_table": "doors", "source_column": "door"},
                    "data": [
                        {"column": "door", "is_source_id": True},
                        {
                            "column": "colour",
                            "faker_provider": "random_element",
                            "source_table": "doors",
                            "source_column": "colour",
                        },
                    ],
                },
            )
        ]
    }
    got = fill_tables(spark, spec, str(tmp_path), 1, ANCHOR, existing={"doors": doors})["bell"].collect()
    assert sorted(r["id"] for r in got) == [1, 2, 3] and sorted(r["door"] for r in got) == [7, 9, 12]
    assert {r["colour"] for r in got} <= {"x", "y"}


def table(name, columns, populate=None, **more):
    made = {"name": name, "columns": [{"name": n, "type": t} for n, t in columns.items()], **more}
    return {**made, "populate": populate} if populate else made


PARENT = table("p", {"id": "INTEGER PRIMARY KEY", "code": "TEXT"}, {"source_data": [{"code": "x"}, {"code": "y"}]})


def test_source_column_is_used(spark, tmp_path):
    child = table(
        "c",
        {"id": "INTEGER PRIMARY KEY", "p_code": "TEXT", "name": "TEXT"},
        {
            "count": 50,
            "data": [
                {"column": "p_code", "faker_provider": "random_element", "source_table": "p", "source_column": "code"},
                {"column": "name", "faker_provider": "first_name"},
            ],
        },
    )
    got = fill(spark, {"tables": [PARENT, child]}, tmp_path, lists={"first_name": ["Ann", "Bo"]})["c"]
    assert {r["p_code"] for r in got.collect()} == {"x", "y"}
    assert {r["name"] for r in got.collect()} == {"Ann", "Bo"}


def test_empty_and_later_parents_give_null_and_no_links(spark, tmp_path):
    empty = table("e", {"id": "INTEGER PRIMARY KEY"})
    reference = {"column": "ref", "faker_provider": "random_element"}
    child = table(
        "c",
        {"id": "INTEGER PRIMARY KEY", "ref": "INTEGER", "later": "INTEGER"},
        {
            "count": 3,
            "data": [{**reference, "source_table": "e"}, {**reference, "column": "later", "source_table": "z"}],
        },
    )
    link = table(
        "l",
        {"p_id": "INTEGER", "ref": "INTEGER"},
        {
            "count_per_source": {"source_table": "p", "min": 1, "max": 2},
            "data": [{"column": "p_id", "is_source_id": True}, {**reference, "source_table": "e"}],
        },
    )
    later = table("z", {"id": "INTEGER PRIMARY KEY"}, {"count": 2, "data": []})
    got = fill(spark, {"tables": [PARENT, empty, child, link, later]}, tmp_path)
    assert rows(got["c"]) == [(1, None, None), (2, None, None), (3, None, None)]
    assert got["l"].count() == 0 and got["e"].count() == 0 and rows(got["z"]) == [(1,), (2,)]


def test_fan_out_rows_can_be_parents(spark, tmp_path):
    fan = table(
        "f",
        {"id": "INTEGER PRIMARY KEY", "p_id": "INTEGER", "v": "INTEGER"},
        {
            "count_per_source": {"source_table": "p", "min": 3, "max": 3},
            "data": [{"column": "p_id", "is_source_id": True}, {"column": "v", "faker_provider": "pyint"}],
        },
    )
    child = table(
        "c",
        {"id": "INTEGER PRIMARY KEY", "f_id": "INTEGER"},
        {"count": 200, "data": [{"column": "f_id", "faker_provider": "random_element", "source_table": "f"}]},
    )
    got = fill(spark, {"tables": [PARENT, fan, child]}, tmp_path)
    assert {r["f_id"] for r in got["c"].collect()} == {1, 2, 3, 4, 5, 6}


def test_second_pass_into_another_table(spark, tmp_path):
    place = table("a", {"id": "INTEGER PRIMARY KEY", "p_id": "INTEGER"}, None)
    place["populate"] = {
        "count": 60,
        "data": [],
        "post_populate": [{"column": "p_id", "faker_provider": "random_element", "source_table": "p"}],
    }
    got = fill(spark, {"tables": [place, PARENT]}, tmp_path)["a"]
    assert got.groupBy().agg(F.min("p_id"), F.max("p_id"), F.count("p_id")).first()[:] == (1, 2, 60)
    assert got.where("id = p_id").count() in (0, 1, 2)


@pytest.mark.parametrize(
    ("populate", "message"),
    [
        ({"count": 1, "data": [{"column": "v"}]}, "no rule"),
        ({"count": 1, "data": [{"column": "v", "faker_provider": "job"}]}, "job"),
        (
            {
                "count_per_source": {"source_table": "p", "min": 1, "max": 1},
                "data": [{"column": "v", "is_source_id": True}],
            },
            "no rule besides",
        ),
        (
            {"map_source": {"source_table": "q"}, "data": [{"column": "v", "is_source_id": True}]},
            "undeclared",
        ),
    ],
)
def test_wrong_rules(spark, tmp_path, populate, message):
    wrong = table("w", {"id": "INTEGER PRIMARY KEY", "v": "INTEGER"}, populate)
    with pytest.raises(ValueError, match=message):
        fill(spark, {"tables": [PARENT, wrong]}, tmp_path)


def test_keys_of_one_file_are_dealt_to_several_tasks(spark, tmp_path, monkeypatch):
    """A parent of many rows is few bytes, which one scan task reads; its children are made by more."""
    monkeypatch.setattr(synthesis, "ROWS_PER_TASK", (100, 4000))
    doors = spark.range(1, 1001).coalesce(1).withColumnRenamed("id", "door")
    columns = [{"name": "bell", "type": "INTEGER PRIMARY KEY"}, {"name": "door", "type": "INTEGER", "foreign_key": "doors(door)"}]
    populate = {"map_source": {"source_table": "doors", "source_column": "door"}, "data": [{"column": "door", "is_source_id": True}]}
    spec = {"tables": [{"name": "bells", "columns": columns, "populate": populate}]}
    bells = fill_tables(spark, spec, str(tmp_path), 1, ANCHOR, existing={"doors": doors})["bells"]
    assert sorted(r.door for r in bells.collect()) == list(range(1, 1001))
    assert bells.select(F.input_file_name()).distinct().count() > 1
