"""The registered queries and the pipeline run over the whole small table."""

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from riskweave.llm import queries

SF = "/root/testdata/sf0.001"
#: These are near enough to their operators, which have tests of their own.
QUICK = ("op2", "op4", "op7", "op9", "op10")


def test_names():
    numbers = sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES)
    assert numbers == list(range(1, 14))
    assert set(queries.QUERIES) < set(entry.queries()) and "pipeline" in entry.queries()


@pytest.mark.parametrize("name", [n for n in queries.QUERIES if n.startswith(QUICK)])
def test_a_row_for_each_document(spark, name):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = queries.QUERIES[name](spark, SF)
    assert sorted(r.doc_id for r in got.select("doc_id").collect()) == sorted(r.doc_id for r in docs.select("doc_id").collect())


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF).cache()
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"] and docs.count() > 0
    out = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert out.count() == docs.count() and {"doc_id", "ids"} <= set(out.columns)
