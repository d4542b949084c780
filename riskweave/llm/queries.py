"""Registered queries of this package: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from riskweave.llm.common import documents
from riskweave.llm.fingerprint_tables import document_fingerprints
from riskweave.llm.grid_join import near_vectors
from riskweave.llm.merkle import manifest
from riskweave.llm.mixing import BLOCK, GOLDEN, ONE, taken_words
from riskweave.llm.piece_codec import encoded
from riskweave.llm.repetition import quality_rules
from riskweave.llm.secret_spans import secret_spans
from riskweave.llm.simhash_trie import near_duplicates
from riskweave.llm.spelling import spelling_groups
from riskweave.llm.statements import COSINE_SQL, MERKLE_SQL, SPELLING_SQL
from riskweave.llm.suffix_dedup import dedup_bytes
from riskweave.llm.token_files import token_files
from riskweave.llm.token_prefix import token_counts
from riskweave.llm.toxicity import toxicity

Query = Callable[[SparkSession, str], DataFrame]


def op1_simhash_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir), words=3, radius=3)


def op2_token_prefix_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"), 4096)


def op3_suffix_merge_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_bytes(documents(spark, sf_dir))


def op4_repetition_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(documents(spark, sf_dir))


def op5_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded(documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"))


def op6_fingerprint_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_fingerprints(documents(spark, sf_dir))


def op7_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return taken_words(documents(spark, sf_dir))


def op8_toxicity_network(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op9_secret_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_spans(documents(spark, sf_dir))


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"), end_id=2)


def op11_spelling_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_groups(documents(spark, sf_dir))


def op12_merkle_climb(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest(documents(spark, sf_dir))


def op13_grid_order_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), cosine=0.95)


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_simhash_trie,
        op2_token_prefix_counts,
        op3_suffix_merge_dedup,
        op4_repetition_rules,
        op5_piece_codec,
        op6_fingerprint_tables,
        op7_source_mix,
        op8_toxicity_network,
        op9_secret_spans,
        op10_token_files,
        op11_spelling_index,
        op12_merkle_climb,
        op13_grid_order_join,
    )
}

#: The mix in closed form: every source takes the first words of its shuffled line, begun
#: anew when it ends, up to its target; the golden-ratio schedule says in which slot the
#: first of a document's blocks comes.
MIX_SQL = f"""
WITH RECURSIVE docs AS (
  SELECT doc_id, source, coalesce(text, '') AS text FROM documents
), sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size,
    substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(text)), 1, 13) AS spot
  FROM docs
), sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, 2.0 * CAST(sum(size) AS DOUBLE) AS most,
    CAST([5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS DOUBLE) AS weight
  FROM sized GROUP BY source
), whole AS (
  SELECT CAST(sum(source_size) AS DOUBLE) * 1.5 AS total FROM sources
), rates(rate) AS (
  SELECT total / sum(weight) FROM sources, whole GROUP BY total
  UNION
  SELECT (total - sum(CASE WHEN weight * rate > most THEN most ELSE 0 END)) / sum(CASE WHEN weight * rate > most THEN 0 ELSE weight END)
  FROM rates, sources, whole GROUP BY rate, total
), goals AS (
  SELECT source, source_size, least(weight * (SELECT max(rate) FROM rates), most) AS target FROM sources
), line AS (
  SELECT s.doc_id, s.source, s.size, g.source_size, g.target, CAST(round(g.target) AS BIGINT) AS stop,
    CAST(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.spot, s.doc_id ROWS UNBOUNDED PRECEDING) AS BIGINT) - s.size AS start
  FROM sized s JOIN goals g ON s.source IS NOT DISTINCT FROM g.source
), numbered AS (
  SELECT source, target, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS no, CAST(ceil(target / {BLOCK}) AS BIGINT) AS slots FROM goals
), units AS (
  SELECT no, slots, CAST(ceil(target / (SELECT sum(target) FROM numbered) * {ONE}) AS BIGINT) AS units FROM numbered WHERE slots > 0
), shares AS (
  SELECT no, slots, CAST(sum(units) OVER (ORDER BY no) AS BIGINT) - units AS low, CAST(sum(units) OVER (ORDER BY no) AS BIGINT) AS high FROM units
), points AS (
  SELECT id AS slot, CAST(floor(((id + 1) * {GOLDEN} % {ONE}) * (CAST((SELECT max(high) FROM shares) AS DOUBLE) / {ONE})) AS BIGINT) AS spot
  FROM range((SELECT CAST(8 * sum(slots) + 64 AS BIGINT) FROM shares)) r(id)
), slots AS (
  SELECT slot, no, row_number() OVER (PARTITION BY no ORDER BY slot) - 1 AS rank FROM points JOIN shares ON spot >= low AND spot < high
), sums AS (
  SELECT l.*, greatest(0, least(start + size, stop) - start) + greatest(0, least(start + size + l.source_size, stop) - start - l.source_size) AS taken
  FROM line l
)
SELECT s.doc_id, s.size, s.source_size, s.target, s.taken, CASE WHEN s.taken > 0 THEN t.slot END AS first_slot
FROM sums s JOIN numbered n ON s.source IS NOT DISTINCT FROM n.source LEFT JOIN slots t ON t.no = n.no AND t.rank = s.start // {BLOCK}
"""

#: Other queries have no statement: the operators' hashes, encoders, suffix orders and
#: trained weights have no SQL counterpart; tests/llm compares them with brute force.
ORACLES: dict[str, str] = {
    "op7_source_mix": MIX_SQL,
    "op11_spelling_index": SPELLING_SQL,
    "op12_merkle_climb": MERKLE_SQL,
    "op13_grid_order_join": COSINE_SQL,
}
