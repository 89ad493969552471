"""The registered queries: against their SQL, and with what the contract says of their columns."""

import pytest

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from fareflow.llm.queries import QUERIES, SQL
from tests.conftest import SMALL
from tools.check import compare, connect


def test_all_are_registered():
    assert [int(name[2:].split("_")[0]) for name in QUERIES] == list(range(1, len(QUERIES) + 1))
    assert set(QUERIES) | {"pipeline"} <= set(queries())
    assert set(SQL) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(SQL))
def test_against_sql(spark, name):
    duck = connect(SMALL)
    assert compare(duck, QUERIES[name](spark, SMALL), SQL[name]) is None


def test_pipeline_is_its_stages(spark):
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    out = corpus_pipeline.run(spark, SMALL)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    assert 0 < out.count()
    assert out.join(docs, "doc_id", "left_anti").isEmpty()
