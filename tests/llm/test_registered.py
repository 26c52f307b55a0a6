"""The registered queries on the smallest tables, against their SQL where they have one, and the pipeline's stages."""

from __future__ import annotations

from pathlib import Path

import pytest

import corpus_pipeline
from recurra.llm import decontamination, queries, simhash
from recurra.llm.common import read_table

FOLDER = "/root/testdata/sf0.001"
SQL = queries.oracle_sql()
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    connection = pytest.importorskip("duckdb").connect()
    for name in ("documents", "pages", "benchmark", "conversations"):
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", SQL)
def test_query_and_its_sql(spark, duck, name):
    df = queries.queries()[name](spark, FOLDER)
    cursor = duck.execute(SQL[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    expected = sorted(repr(dict(sorted(zip(columns, r)))) for r in cursor.fetchall())
    assert sorted(repr(dict(sorted(r.asDict().items()))) for r in df.collect()) == expected


@pytest.mark.parametrize("name", ["op1_line_dedup", "op4_license_scan", "op9_quality_rules"])
def test_native_queries_run_no_python(spark, name):
    plan = queries.queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "InArrow" not in plan and "InPandas" not in plan and "CartesianProduct" not in plan


def test_pipeline(spark, tmp_path):
    docs = read_table(spark, FOLDER, "documents")
    whole, columns = docs.count(), docs.columns
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        path = f"{tmp_path}/{number}"
        stage(spark, docs, FOLDER).write.parquet(path)
        docs = spark.read.parquet(path)
        assert 0 < docs.count() <= whole
        whole = docs.count()
        if number < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns
        if name == "simhash near-dedup":
            found = simhash.simhash_components(docs)
            assert found.select("component_id").distinct().count() == whole
        if name == "benchmark decontamination":
            hits = decontamination.report(decontamination.find_contamination(docs, read_table(spark, FOLDER, "benchmark")))
            assert hits.where("contaminated").count() == 0
    assert docs.columns == [*columns, "mix"]
    assert docs.selectExpr("min(mix.taken) > 0 AND max(mix.copies) <= 2 AS ok").first()["ok"]


def test_pipeline_takes_documents_without_labels_or_rows(spark):
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    docs = spark.createDataFrame([], schema)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, FOLDER).count() == 0
