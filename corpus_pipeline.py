"""A training corpus from ``documents``: rules, near copies, secrets, mix, token ids.

Each stage takes the table that the one before it wrote, and works on all of it. All but
the last return the columns of ``documents``:

* quality_rules: documents that the rules on repetition reject go;
* near_copies: of each group of near copies, by 5-word shingles at a similarity of 0.8 or
  more, the document of the smallest doc_id stays;
* secret_spans: secrets are masked in the texts, n_chars follows;
* source_mix: documents appear as often as the target weights of their sources ask, at
  most twice;
* piece_codec: token ids of the texts, and whether they decode to them.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from riskweave.llm.common import documents, written
from riskweave.llm.mixing import mixed
from riskweave.llm.near_copies import one_of_each
from riskweave.llm.piece_codec import encoded
from riskweave.llm.repetition import kept_rows
from riskweave.llm.secret_spans import redacted


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return kept_rows(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return one_of_each(docs, words=5, similarity=0.8)


def secret_spans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return redacted(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixed(docs)


def piece_codec(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return encoded(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("quality_rules", quality_rules),
    ("near_copies", near_copies),
    ("secret_spans", secret_spans),
    ("source_mix", source_mix),
    ("piece_codec", piece_codec),
]

#: The stages' hashes and encoders have no SQL counterpart.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
