"""The registered queries, their SQL, and the pipeline stage by stage."""

import os
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from check_oracle import table_of
from contestlab.llm.common import stored
from tests.llm.test_operators import KEYED, ROWS, SCHEMA, classes_of

SF_DIR = "/root/testdata/sf0.001"
there = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="needs the generated tables")


def test_one_query_per_operator():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in entry.queries() if n.startswith("op") and n[2].isdigit()) == list(range(1, 14))
    assert entry.queries()["pipeline"] is corpus_pipeline.run and "pipeline" not in entry.oracle_sql()


@there
@pytest.mark.parametrize("name", ["op1_mix_sources", "op5_line_dedup", "op11_resample", "op13_ranked_search"])
def test_query_equals_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for table in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    df = entry.queries()[name](spark, SF_DIR)
    cur = con.execute(entry.oracle_sql()[name])
    assert table_of(df.columns, [tuple(r) for r in df.collect()]) == table_of([d[0] for d in cur.description], cur.fetchall())


@there
def test_pipeline_keeps_columns_and_clean_documents(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    good = {r.doc_id for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").where("quality = 1").collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stored(stage(spark, docs, SF_DIR), "test-stage")
        assert out.columns == docs.columns and out.schema == docs.schema, name
        if name == "quality classifier":
            ids = {r.doc_id for r in out.select("doc_id").collect()}
            assert len(good & ids) >= 0.97 * len(good)
        docs = out


@there
def test_stages_on_hard_rows(spark):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    assert corpus_pipeline.classify(spark, docs, SF_DIR).columns == docs.columns
    deduped = corpus_pipeline.drop_lines(spark, docs, SF_DIR)
    assert deduped.count() == len(ROWS) and deduped.where("text IS NULL").count() == sum(r[1] is None for r in ROWS)
    kept = Counter(r.doc_id for r in corpus_pipeline.drop_near(spark, docs, SF_DIR).collect())
    assert kept == Counter({root: least for _, least, _, root in classes_of(ROWS)}.values())
    mixed = corpus_pipeline.mix(spark, spark.createDataFrame(KEYED, SCHEMA), SF_DIR)
    assert mixed.columns == docs.columns and max(Counter(r.doc_id for r in mixed.collect()).values()) <= 3
    assert corpus_pipeline.encode(spark, docs, SF_DIR).count() == len(ROWS)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), SF_DIR).isEmpty()
