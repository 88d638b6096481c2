"""Contract queries and the pipeline on the driver's small tables."""

import os

import duckdb
import pandas as pd
import pytest

import corpus_pipeline
from siftline.llm import queries
from siftline.llm.common import table

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_matches_sql(spark, name):
    con = duckdb.connect()
    for file in os.listdir(SF):
        con.sql(f"CREATE VIEW {file.split('.')[0]} AS SELECT * FROM read_parquet('{SF}/{file}')")
    got, want = queries.QUERIES[name](spark, SF).toPandas(), con.sql(queries.ORACLE_SQL[name]).df()
    columns = sorted(want.columns)
    value = lambda v: None if pd.isna(v) else int(v) if isinstance(v, float) else v
    rows = lambda d: sorted((tuple(map(value, r)) for r in d[columns].astype(object).itertuples(index=False)), key=str)
    assert rows(got) == rows(want)


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.ORACLE_SQL)))
def test_a_row_per_document(spark, name):
    ids = queries.QUERIES[name](spark, SF).select("doc_id").distinct().count()
    assert ids == table(spark, SF, "documents").select("doc_id").distinct().count()


def test_pipeline_stages_keep_columns_and_take_effect(spark):
    docs = table(spark, SF, "documents")
    extra = spark.createDataFrame([(10**6 + i, t, "en", "s", 0) for i, t in enumerate(["1234 !!", None, ""])] + [(None, "The and of the thing with words.", "en", "s", 33)], docs.schema)
    docs = docs.unionByName(extra)
    sizes = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        new = stage(spark, docs, SF)
        assert new.columns == docs.columns and dict(new.dtypes) == dict(docs.dtypes)
        docs = corpus_pipeline.materialize(new, name)
        sizes.append(docs.count())
    assert docs.where("doc_id >= 1000000").count() == 0
    assert docs.where("doc_id is null").count() == 1
    assert sizes[0] > sizes[2] and sizes[2] == sizes[3]
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert packed.select("doc_id").distinct().count() == docs.count()


def test_pipeline_on_an_empty_table(spark):
    docs = table(spark, SF, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.count() == 0
