import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import types as T

from tablekin.plans import catalog
from tablekin.sources import jdbc, lake
from tablekin.staging import shared_folder

LOGIN = {"host": "db", "port": 1, "user": "u", "password": "p"}


@pytest.mark.parametrize(
    ("kind", "params", "expected"),
    [
        ("SQLite", {"db_path": "a/b.db"}, {"url": "jdbc:sqlite:a/b.db", "driver": "org.sqlite.JDBC"}),
        (
            "postgresql",
            {**LOGIN, "database": "d", "type": "postgresql"},
            {"url": "jdbc:postgresql://db:1/d", "driver": "org.postgresql.Driver", "user": "u", "password": "p"},
        ),
        (
            "MYSQL",
            {**LOGIN, "database": "d"},
            {"url": "jdbc:mysql://db:1/d", "driver": "com.mysql.cj.jdbc.Driver", "user": "u", "password": "p"},
        ),
        (
            "oracle",
            {**LOGIN, "service_name": "s"},
            {
                "url": "jdbc:oracle:thin:@//db:1/s",
                "driver": "oracle.jdbc.OracleDriver",
                "user": "u",
                "password": "p",
            },
        ),
    ],
)
def test_options(kind, params, expected):
    assert jdbc.jdbc_options(kind, **params) == expected


def test_option_errors():
    with pytest.raises(ValueError, match="sqlite, postgresql, mysql, oracle"):
        jdbc.jdbc_options("mongo", host="x")
    with pytest.raises(ValueError, match="host, port, database, user, password; missing: database"):
        jdbc.jdbc_options("mysql", **LOGIN)
    with pytest.raises(ValueError, match="schema"):
        jdbc.jdbc_options("sqlite", db_path="x", schema="y")


class FakeReader:
    """Stands in for ``spark.read`` and answers the bounds query."""

    def __init__(self, bounds):
        self.bounds, self.loads = bounds, []

    @property
    def read(self):
        return self

    def format(self, name):
        assert name == "jdbc"
        return self

    def options(self, **options):
        self.loads.append(options)
        return self

    def load(self):
        return self

    def jdbc(self, url, table, predicates, properties):
        self.loads.append((url, table, predicates, properties))
        return self

    def first(self):
        return self.bounds


def test_plain_read_strips_the_semicolon():
    spark = FakeReader(None)
    jdbc.JdbcSource(spark, "sqlite", db_path="x.db").query(" SELECT 1 AS a ;\n")
    assert spark.loads == [
        {"url": "jdbc:sqlite:x.db", "driver": "org.sqlite.JDBC", "dbtable": "(SELECT 1 AS a) t", "fetchsize": "10000"}
    ]


def test_partitioned_read_asks_for_missing_bounds():
    spark = FakeReader((3, 90))
    jdbc.read_sql(spark, {"url": "u"}, "SELECT * FROM big", jdbc.Partitioning("id", 16))
    probe, scan = spark.loads
    assert probe == {"url": "u", "dbtable": "(SELECT MIN(id) AS low, MAX(id) AS high FROM (SELECT * FROM big) t) t"}
    assert scan == {
        "url": "u",
        "dbtable": "(SELECT * FROM big) t",
        "fetchsize": "10000",
        "partitionColumn": "id",
        "lowerBound": "3",
        "upperBound": "90",
        "numPartitions": "16",
    }


def test_partitioned_read_with_bounds_or_without_rows():
    spark = FakeReader((None, None))
    jdbc.read_sql(spark, {}, "SELECT 1", jdbc.Partitioning("id", 4, 0, 9))
    assert [s.get("upperBound") for s in spark.loads] == ["9"]
    spark = FakeReader((None, None))
    jdbc.read_sql(spark, {}, "SELECT 1", jdbc.Partitioning("id", 4))
    assert len(spark.loads) == 2 and "partitionColumn" not in spark.loads[1]


def test_read_by_conditions():
    spark = FakeReader(None)
    jdbc.read_sql(spark, {"url": "u", "driver": "d"}, "SELECT * FROM t;", ["a < 'm'", "a >= 'm' OR a IS NULL"])
    assert spark.loads == [
        ("u", "(SELECT * FROM t) t", ["a < 'm'", "a >= 'm' OR a IS NULL"], {"driver": "d", "fetchsize": "10000"})
    ]


def test_a_missing_driver_fails_on_load(spark):
    with pytest.raises((PySparkException, Exception), match="sqlite"):
        jdbc.JdbcSource(spark, "sqlite", db_path="x.db").query("SELECT 1")


def test_catalog_rows_are_named_and_cast_by_position(spark):
    raw = spark.createDataFrame([("T", 1.0, "C", "NUMBER", 0)], "A string, B double, C string, D string, E int")
    got = jdbc._as_rows(raw, catalog.COLUMN_ROWS)
    assert got.schema.simpleString() == (
        "struct<table_name:string,position:int,column_name:string,data_type:string,nullable:boolean>"
    )
    assert tuple(got.first()) == ("T", 1, "C", "NUMBER", False)
    assert set(jdbc.COLUMN_QUERIES) == set(jdbc.KEY_QUERIES) == set(jdbc.DATABASES)


def test_catalog_queries_name_and_type_their_columns(spark):
    class Columns(FakeReader):
        def toDF(self, *names):
            return self

        def select(self, *columns):
            return self

    reader = Columns(None)
    source = jdbc.JdbcSource(reader, "Oracle", **LOGIN, service_name="s")
    source._catalog("SELECT 1, 2", "a string, b boolean")
    (scan,) = reader.loads
    assert scan["dbtable"] == "(WITH catalog_rows (a, b) AS (SELECT 1, 2) SELECT * FROM catalog_rows) t"
    assert scan["customSchema"] == "a string, b int"


def test_inline_rows(spark):
    schema = T.StructType.fromDDL("id bigint, name string, score double, day date, at timestamp_ntz, n bigint")
    records = [
        {"name": "a", "score": 1, "day": "2024-01-02", "at": "2024-01-02T03:04:05"},
        {"name": None, "n": None},
        {"id": 77, "n": 4},
    ]
    got = [tuple(r) for r in lake.inline_rows(spark, records, schema, "id", 10, {"n": 0, "name": "?"}).collect()]
    assert [r[0] for r in got] == [10, 11, 77]
    assert [r[1] for r in got] == ["a", None, "?"]
    assert [r[5] for r in got] == [0, None, 4]
    assert str(got[0][2:5]) == "(1.0, datetime.date(2024, 1, 2), datetime.datetime(2024, 1, 2, 3, 4, 5))"
    with pytest.raises(ValueError, match="typo"):
        lake.inline_rows(spark, [{"typo": 1}], schema)


def test_inline_rows_of_other_types(spark):
    schema = T.StructType.fromDDL("id bigint, tags array<string>")
    got = lake.inline_rows(spark, [{"tags": ["a"]}, {}], schema, "id").collect()
    assert [tuple(r) for r in got] == [(1, ["a"]), (2, None)]


def test_sql_over_named_tables(spark):
    got = lake.run_sql(spark, {"t": spark.range(5)}, "SELECT max(id) AS top FROM t ; ")
    assert got.collect()[0]["top"] == 4


def test_write_modes(spark, tmp_path):
    path = str(tmp_path / "t")
    assert lake.existing_table(spark, path) is None
    assert lake.write_table(spark.range(3), path).count() == 3
    assert lake.write_table(spark.range(2), path, overwrite=False).count() == 5
    assert lake.write_table(spark.range(4), path).count() == 4
    assert lake.existing_table(spark, path).count() == 4


@pytest.mark.parametrize("source", ["/data/company.sqlite", "company", "s3://bucket/company.db/"])
def test_description_name(spark, tmp_path, source):
    document = spark.createDataFrame([('{"a": 1}',)], "document string")
    path = lake.write_description(document, str(tmp_path / "new"), source)
    assert path.endswith("/new/company_description.json")
    assert json.loads(spark.read.text(path).first()[0]) == {"a": 1}


def test_shared_folder_comes_from_the_session(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


class ClusterSession:
    class conf:
        @staticmethod
        def get(name, default):
            return default

    class sparkContext:
        master = "spark://somewhere:7077"

        @staticmethod
        def getCheckpointDir():
            return None


def test_a_cluster_without_a_shared_folder_is_an_error():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(ClusterSession())


def test_catalog_tables_leave_out_views(spark):
    spark.range(3).write.mode("overwrite").saveAsTable("base_table")
    spark.sql("CREATE OR REPLACE VIEW a_view AS SELECT * FROM base_table")
    spark.range(2).createOrReplaceTempView("a_temporary_view")
    try:
        assert {n: df.count() for n, df in lake.catalog_tables(spark).items()} == {"base_table": 3}
    finally:
        spark.sql("DROP VIEW a_view")
        spark.sql("DROP TABLE base_table")
