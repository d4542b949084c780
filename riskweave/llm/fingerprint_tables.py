"""Document fingerprints: SimHash over weighted terms, and permuted block tables for search.

Only DataFrame and SQL functions. Terms are pairs of neighbouring words (the word itself
where a text has one), lower-cased; a term weighs as many as it has code points, since
long terms are rare ones. Each term's 64-bit hash votes with its weight, for a bit if it is
set and against it if not; a fingerprint has the bits with more votes for than against.
Two counters share a 64-bit sum, so that a text's votes are 32 sums over its terms.

Search cuts fingerprints into BLOCKS blocks. Two fingerprints within the radius agree in at
least BLOCKS - radius of them; there is one table for each choice of so many blocks, keyed by
those bits. A pair is found in every table whose blocks agree and kept in the first.

Defined results: null and empty texts have no terms and the fingerprint 0; equal texts have
equal fingerprints; the next document of the row with the smallest id is the one with the
largest, and with one row it is the row itself; rows of equal id follow each other by text;
null ids come after all others; repeated rows each get a row; an empty table gives an
empty result.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskweave.llm.common import SPACE, texts, written

BLOCKS = 6
RADIUS = 3
#: Rows of a bucket of the ordered table, roughly, and the most buckets.
BUCKET = 500
BUCKETS = 2047
#: The separators of words.
SPACES = " \t\n\x0b\x0c\r"


def words_of(text: Column) -> Column:
    """The lower-cased words; a text without any has one empty word."""
    return F.split(F.btrim(F.lower(text), F.lit(SPACES)), f"{SPACE}+")


def fingerprints(rows: DataFrame, text: str, *keys: str) -> DataFrame:
    """(*keys, fp): the fingerprint of each row's ``text``; the keys must tell rows apart."""
    words = rows.select(*keys, words_of(F.col(text)).alias("w"))
    after = F.slice("w", F.lit(2), F.size("w"))
    pairs = words.select(*keys, F.posexplode(F.arrays_zip(F.col("w").alias("a"), after.alias("b"))).alias("i", "t"))
    term = F.when(F.col("t.b").isNull(), F.col("t.a")).otherwise(F.concat_ws(" ", "t.a", "t.b"))
    votes = pairs.filter(F.col("t.b").isNotNull() | (F.col("i") == 0)).select(*keys, term.alias("term"))
    votes = votes.select(*keys, F.xxhash64("term").alias("h"), F.char_length("term").cast("long").alias("n"))
    both = F.lit(0x0000000100000001)
    sums = [F.sum(F.shiftrightunsigned("h", i).bitwiseAND(both) * F.col("n")).alias(f"s{i}") for i in range(32)]
    counted = votes.groupBy(*keys).agg(F.sum("n").alias("all"), *sums)
    # Bit i is voted on in the lower half of sum i, bit i + 32 in the upper half.
    fp = F.lit(0).cast("long")
    for i in range(64):
        s = F.col(f"s{i % 32}")
        votes_for = s.bitwiseAND(F.lit(0xFFFFFFFF)) if i < 32 else F.shiftrightunsigned(s, 32)
        bit = F.lit(signed(1 << i)).cast("long")
        fp = fp.bitwiseOR(F.when(votes_for * 2 > F.col("all"), bit).otherwise(F.lit(0).cast("long")))
    return counted.select(*keys, fp.alias("fp"))


def signed(bits: int) -> int:
    """64 bits as the signed number that Spark has for them."""
    return bits - ((bits >> 63) << 64)


def likeness(a: Column, b: Column) -> Column:
    """Share of equal bits."""
    return F.lit(1.0) - F.bit_count(a.bitwiseXOR(b)) / 64.0


def hex_fingerprint(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def with_buckets(rows: DataFrame) -> DataFrame:
    """``rows`` with ``bucket``, its place in descending order of doc_id, null ids last.

    The borders are quantiles, at most BUCKETS of them whatever the table, and a row
    finds its own by halving, one column for each step.
    """
    n = rows.count()
    steps = max(0, min(BUCKETS, n // BUCKET).bit_length())
    shares = [i / (1 << steps) for i in range(1, 1 << steps)]
    found = rows.agg(F.percentile_approx("doc_id", shares, 8 << steps).alias("q")).first()["q"] if shares else []
    borders = F.array(*[F.lit(int(q)).cast("long") for q in found or [0] * len(shares)])
    out = rows.withColumn("bucket", F.lit(0))
    for k in range(steps - 1, -1, -1):
        above = F.col("doc_id") > F.element_at(borders, F.col("bucket") + F.lit(1 << k))
        out = out.withColumn("bucket", F.col("bucket") + F.when(above, F.lit(1 << k)).otherwise(F.lit(0)))
    return out.withColumn("bucket", F.when(F.col("doc_id").isNull(), F.lit(1)).otherwise(-F.col("bucket")))


def with_next(rows: DataFrame) -> DataFrame:
    """(bucket, nth, row, doc_id, text, next_row, next_text): rows with the next one by descending doc_id.

    A window looks ahead inside each bucket of ids; the last row of a bucket gets the
    first of the next bucket that has rows.
    """
    dealt = with_buckets(rows).withColumn("row", F.xxhash64("doc_id", "text"))
    inside = Window.partitionBy("bucket").orderBy(F.col("doc_id").desc_nulls_last(), F.col("text"))
    ahead = dealt.select(
        "*",
        F.row_number().over(inside).alias("nth"),
        F.lead("row").over(inside).alias("next_row"),
        F.lead("text").over(inside).alias("next_text"),
    )
    first = F.min_by(F.struct("row", "text"), F.struct((-F.col("doc_id")).alias("i"), F.col("text")))
    firsts = dealt.groupBy("bucket").agg(first.alias("f"))
    # One row for each bucket, at most BUCKETS + 1.
    ring = Window.orderBy("bucket")
    round_ = firsts.select("bucket", F.coalesce(F.lead("bucket").over(ring), F.min("bucket").over(ring)).alias("after"))
    heads = round_.join(firsts.select(F.col("bucket").alias("after"), "f"), "after").select("bucket", "f")
    return ahead.join(heads, "bucket").select(
        "bucket", "nth", "row", "doc_id", "text",
        F.coalesce("next_row", F.col("f.row")).alias("next_row"),
        F.coalesce("next_text", F.col("f.text")).alias("next_text"),
    )


def within_radius(queries: DataFrame, index: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """(a, b, bits): the pairs of a fingerprint of ``queries`` and one of ``index``, both distinct, within ``radius``."""
    edges = [64 * i // blocks for i in range(blocks + 1)]
    parts = [(1 << edges[i + 1]) - (1 << edges[i]) for i in range(blocks)]
    kept = [signed(sum(parts[i] for i in c)) for c in combinations(range(blocks), blocks - radius)]
    masks = F.array(*[F.lit(m).cast("long") for m in kept])

    def table(df: DataFrame, name: str) -> DataFrame:
        each = df.select(F.col("fp").alias(name), F.posexplode(masks).alias("table", "mask"))
        return each.select(name, "table", F.col(name).bitwiseAND(F.col("mask")).alias("key"))

    differs = F.col("a").bitwiseXOR(F.col("b"))
    first = F.lit(len(kept))
    for i in range(len(kept) - 1, -1, -1):
        first = F.when(differs.bitwiseAND(F.lit(kept[i]).cast("long")) == 0, F.lit(i)).otherwise(first)
    left, right = table(queries, "a"), table(index, "b").withColumnsRenamed({"table": "_table", "key": "_key"})
    near = (F.col("table") == F.col("_table")) & (F.col("key") == F.col("_key")) & (F.bit_count(differs) <= radius) & (first == F.col("table"))
    return left.join(right, near).select("a", "b", F.bit_count(differs).alias("bits"))


def document_fingerprints(docs: DataFrame, queries_every: int = 20, radius: int = RADIUS) -> DataFrame:
    """Fingerprints of each row and of its edited text, and how alike they are.

    The edited text has its last third replaced by the beginning of the next document.
    ``n_near``: for rows whose id ``queries_every`` divides, the other rows with a
    fingerprint within ``radius``; null for other rows.
    """
    rows = with_next(texts(docs))
    cut = F.floor(F.char_length("text") / 3).cast("int")
    kept = F.substr("text", F.lit(1), F.char_length("text") - cut)
    edited = rows.withColumn("edited", F.concat(kept, F.substr("next_text", F.lit(1), cut)))
    facts = edited.withColumns({"n_chars": F.char_length("text").cast("long"), "edited_sha256": F.sha2("edited", 256)})
    both = facts.withColumn("of", F.explode(F.array(F.lit(0), F.lit(1))))
    both = both.withColumn("text", F.when(F.col("of") == 0, F.col("text")).otherwise(F.col("edited")))
    keys = ["bucket", "nth", "of", "row", "doc_id", "next_row", "n_chars", "edited_sha256"]
    prints = written(fingerprints(both, "text", *keys), "fingerprints")
    own = prints.filter("of = 0").drop("of")
    other = prints.filter("of = 1").select("bucket", "nth", F.col("fp").alias("edited_fp"))
    after = own.select(F.col("row").alias("next_row"), F.col("fp").alias("next_fp")).distinct()
    out = own.join(other, ["bucket", "nth"]).join(after, "next_row")

    asks = F.col("doc_id") % queries_every == 0
    index = own.groupBy("fp").agg(F.count(F.lit(1)).alias("n"))
    near = within_radius(own.filter(asks).select("fp").distinct(), index.select("fp"), radius)
    near = near.join(index.withColumnRenamed("fp", "b"), "b").groupBy("a").agg(F.sum("n").alias("_near"))
    out = out.join(near, (F.col("fp") == F.col("a")) & asks, "left")
    return out.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        hex_fingerprint(F.col("fp")).alias("fingerprint"),
        hex_fingerprint(F.col("edited_fp")).alias("edited_fingerprint"),
        likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"),
        likeness(F.col("fp"), F.col("next_fp")).alias("near_next"),
        F.when(asks, F.col("_near") - 1).alias("n_near"),
    )
