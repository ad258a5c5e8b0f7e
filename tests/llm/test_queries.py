"""The registered queries and the pipeline on the test tables."""

import duckdb
import pytest

import corpus_pipeline
from tablekin.llm import queries

SMALL, TWIN = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", [n for n in queries.QUERIES if n != "pipeline"])
def test_query_runs(spark, name):
    assert queries.QUERIES[name](spark, SMALL).count() > 0


def test_license_twin(spark):
    got = sorted(map(tuple, queries.QUERIES["op2_license_scan"](spark, TWIN).collect()))
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{TWIN}/documents.parquet'")
    assert got == sorted(con.sql(queries.oracles()["op2_license_scan"]).fetchall())


def test_pipeline_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    bench = [r.text.lower() for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    kept = {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SMALL)
        if k < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == corpus_pipeline.COLUMNS
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        kept[name] = [r.doc_id for r in docs.collect()]
        if name == "decontamination":
            assert not any(b in r.text.lower() for r in docs.collect() for b in bench)
    assert set(kept["ngram_join"]) <= set(kept["toxicity"]) and set(kept["decontamination"]) <= set(kept["ngram_join"])
    assert sorted(kept["mixing"]) == sorted(kept["token_binary"])
    again = sorted(map(tuple, corpus_pipeline.run(spark, SMALL).collect()))
    assert again == sorted(map(tuple, docs.collect()))
