"""The registered corpus queries against their SQL, and the pipeline."""

import compare
import pytest

import corpus_pipeline
from chunkloom.llm.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return compare.connect(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, FOLDER)
    rows = [tuple(r) for r in df.collect()]
    assert rows
    if name in ORACLES:
        found = con.execute(ORACLES[name])
        problem = compare.difference(df.columns, rows, [d[0] for d in found.description], found.fetchall())
        assert problem is None, problem


def test_pipeline_keeps_columns_and_takes_effect(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    before = docs.count()
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, FOLDER)
        assert out.columns == docs.columns
        docs = spark.createDataFrame(out.collect(), out.schema)
    assert 0 < docs.count() < before
    mixed = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER)
    assert mixed.count() > 0
