"""Mixing sources to target weights by a low-discrepancy schedule.

The points frac((i + 1) * golden ratio) fall into [0, 1); each falls into the interval that its
source's share has in the cumulative weights, which gives the source of slot i. Slots
are ranked within their source; the slot of rank r takes the r-th block of BLOCK words
of that source's line of documents, which are laid out one after another in the order
of a hash, the line beginning anew when it ends. So every stretch of the schedule has the
target mix, all blocks are equally long, and a source stops exactly at its target.

Ranks and places are two-level prefix sums: within buckets of bounded size, and over the
buckets. No source, however large, meets in one task.

Defined results: a null or empty text has size 0 and is taken 0 times; null sources are one
source, last; repeated rows are laid out as rows of their own; null ids too; an empty
table, or one without words, gives targets of 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskweave.llm.common import WORD, texts
from riskweave.session import cut_lineage

#: Words of a block. Documents and slots of a bucket, roughly.
BLOCK = 2048
BUCKET = 4096
WEIGHTS = (5, 2, 1)
TOTAL = 1.5
MOST = 2.0
#: The golden ratio's fraction in units of 2 ** -32: exact in 64-bit arithmetic.
GOLDEN = 2654435769
SPOT_BITS = 52
ONE = 1 << 32


def running(df: DataFrame, keys: list[str], bucket: str, order: list[Column], value: str, alias: str) -> DataFrame:
    """Add ``alias``: the sum of ``value`` over the rows of the same ``keys`` before each row.

    Rows are ordered by ``bucket`` and ``order``; a task holds a bucket, and then the
    sums of the buckets of one of the ``keys``.
    """
    sums = df.groupBy(*keys, bucket).agg(F.sum(value).alias("_sum"))
    over = Window.partitionBy(*keys).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select(*keys, bucket, F.coalesce(F.sum("_sum").over(over), F.lit(0)).alias("_base"))
    within = Window.partitionBy(*keys, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum(value).over(within), F.lit(0))
    out = df.withColumn("_before", before).join(bases, [*keys, bucket])
    return out.withColumn(alias, (F.col("_before") + F.col("_base")).cast("long")).drop("_before", "_base")


def source_targets(sizes: DataFrame) -> DataFrame:
    """(source_no, weight, source_size, n_docs, target) of rows (source_no, source_size, n_docs).

    The shares of sources at their limit go back to the others by weight until none is
    above: each round is one aggregate over the sources.
    """
    pick = F.array(*[F.lit(float(w)) for w in WEIGHTS])
    known = cut_lineage(
        sizes.withColumn("weight", F.element_at(pick, (F.pmod(F.col("source_no"), F.lit(len(WEIGHTS))) + 1).cast("int")))
        .withColumn("most", F.col("source_size") * MOST)
        .withColumn("full", F.lit(False))
    )
    total = (known.agg(F.sum("source_size").alias("n")).first()["n"] or 0) * TOTAL
    while True:
        left = known.agg(
            F.sum(F.when(F.col("full"), F.col("most"))).alias("taken"),
            F.sum(F.when(~F.col("full"), F.col("weight"))).alias("weight"),
        ).first()
        rate = (total - (left["taken"] or 0.0)) / left["weight"] if left["weight"] else 0.0
        over = ~F.col("full") & (F.col("weight") * F.lit(rate) > F.col("most"))
        if known.filter(over).isEmpty():
            break
        known = cut_lineage(known.withColumn("full", F.col("full") | over))
    target = F.when(F.col("full"), F.col("most")).otherwise(F.col("weight") * F.lit(rate))
    return cut_lineage(known.select("source_no", "weight", "source_size", "n_docs", target.alias("target")))


def numbered_sources(rows: DataFrame) -> DataFrame:
    """(source, source_no, source_size, n_docs): sources in code point order, null last, from 0.

    The names are few next to the rows; their numbers are prefix sums over ranges.
    """
    each = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    each = each.withColumn("one", F.lit(1)).withColumn("bucket", F.coalesce(F.substring(F.hex("source"), 1, 4), F.lit("~")))
    ranked = running(each.withColumn("all", F.lit(0)), ["all"], "bucket", [F.col("source").asc_nulls_last()], "one", "source_no")
    return cut_lineage(ranked.select("source", "source_no", "source_size", "n_docs"))


def schedule(targets: DataFrame, block: int = BLOCK) -> DataFrame:
    """(slot, source_no, rank): which block of which source each slot takes, in order.

    A source with target t has ceil(t / block) slots. Points that fall to a source
    that has all its blocks are dropped; if one lacks slots, the sequence goes on.
    """
    spark = targets.sparkSession
    need = targets.select("source_no", "target", F.ceil(F.col("target") / block).alias("slots"))
    need = need.filter("slots > 0").withColumn("all", F.lit(0)).withColumn("bucket", F.floor(F.col("source_no") / BUCKET))
    total = need.agg(F.sum("slots").alias("n"), F.sum("target").alias("t"), F.max(F.col("target") / F.col("slots")).alias("x")).first()
    if not total["n"]:
        return spark.createDataFrame([], "slot long, source_no long, rank long")
    # Cumulative shares in whole units of 2 ** -32 keep the borders the same on every run.
    share = running(need.withColumn("units", F.ceil(F.col("target") / F.lit(total["t"]) * ONE).cast("long")), ["all"], "bucket", [F.col("source_no")], "units", "low")
    share = cut_lineage(share.select("source_no", "slots", "low", (F.col("low") + F.col("units")).alias("high")))
    top = share.agg(F.max("high")).first()[0]
    # Cells cut [0, top) evenly, so that points meet shares by an equi-join.
    cells = 1024
    cell = -(-top // cells)
    reach = share.withColumn("cell", F.explode(F.sequence(F.floor(F.col("low") / cell), F.floor((F.col("high") - 1) / cell))))
    length = int(total["n"]) + 64
    while True:
        place = F.expr(f"pmod((id + 1) * {GOLDEN}L, {ONE}L)")
        points = spark.range(length).select(F.col("id").alias("slot"), F.floor(place * (top / ONE)).cast("long").alias("at"))
        points = points.withColumn("cell", F.floor(F.col("at") / cell)).withColumn("bucket", F.floor(F.col("slot") / BUCKET))
        hit = points.join(reach, "cell").filter("at >= low AND at < high").withColumn("one", F.lit(1))
        ranked = running(hit, ["source_no"], "bucket", [F.col("slot")], "one", "rank").filter("rank < slots")
        found = cut_lineage(ranked.select("slot", "source_no", "rank"))
        if found.count() == total["n"]:
            return found
        length *= 2


def _spot() -> Column:
    """Where a row stands in the shuffled order: SPOT_BITS bits of a hash of its id and text."""
    named = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.md5("text"))
    return F.conv(F.substring(F.md5(named), 1, SPOT_BITS // 4), 16, 10).cast("long")


def laid_out(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """``rows`` with source_no and ``start``: the words before each row on its source's line."""
    names = sources.select("source", "source_no", "source_size", "n_docs")
    placed = rows.join(F.broadcast(names) if names.count() <= 10_000 else names, rows["source"].eqNullSafe(names["source"]))
    placed = placed.drop(names["source"])
    buckets = F.ceil(F.col("n_docs") / BUCKET)
    # Buckets cut the range of spots evenly, so that the line follows the spots.
    placed = placed.withColumn("bucket", F.floor(F.shiftright("spot", SPOT_BITS - 32) * buckets / F.lit(1 << 32)))
    return running(placed, ["source_no"], "bucket", [F.col("spot"), F.col("doc_id"), F.col("mark")], "size", "start")


def mixture(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """(doc_id, source, mark, size, source_size, target, slot, words): the documents' parts in the slots.

    One row for each part of a document that a slot takes, and one without a slot for a
    document that none takes. ``mark`` is a hash of the text.
    """
    rows = texts(docs, "source").withColumn("source", F.col("source").cast("string"))
    rows = rows.select("doc_id", "source", F.xxhash64("text").alias("mark"), _spot().alias("spot"), F.regexp_count("text", F.lit(WORD)).cast("long").alias("size"))
    rows = cut_lineage(rows)
    sources = numbered_sources(rows)
    targets = source_targets(sources.select("source_no", "source_size", "n_docs"))
    slots = schedule(targets, block)
    known = sources.join(targets.select("source_no", "target"), "source_no")
    line = laid_out(rows, known.select("source", "source_no", "source_size", "n_docs", "target"))
    goals = targets.select("source_no", "target")
    line = line.join(F.broadcast(goals) if goals.count() <= 10_000 else goals, "source_no")
    line = line.withColumn("stop", F.round("target").cast("long"))
    # Where a document's copies lie on the line that goes on after its end.
    times = F.when(F.col("source_size") > 0, F.ceil(F.col("stop") / F.col("source_size"))).otherwise(1)
    copies = line.withColumn("turn", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(times, F.lit(1)) - 1)))
    copies = copies.withColumn("from", F.col("start") + F.col("turn") * F.col("source_size"))
    copies = copies.withColumn("to", F.least(F.col("from") + F.col("size"), F.col("stop")))
    taken = copies.filter("to > from")
    taken = taken.withColumn("rank", F.explode(F.sequence(F.floor(F.col("from") / block), F.floor((F.col("to") - 1) / block))))
    words = F.least(F.col("to"), (F.col("rank") + 1) * block) - F.greatest(F.col("from"), F.col("rank") * block)
    parts = taken.withColumn("words", words).join(slots, ["source_no", "rank"])
    parts = parts.select("doc_id", "source", "mark", "size", "source_size", "target", "slot", "words")
    none = line.filter("start >= stop OR size = 0").select(
        "doc_id", "source", "mark", "size", "source_size", "target", F.lit(None).cast("long").alias("slot"), F.lit(0).cast("long").alias("words")
    )
    return parts.union(none)


def taken_words(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """(doc_id, size, source_size, target, taken, first_slot): what the mix takes of each row.

    Rows that are equal in doc_id, source and text share one row each time: their words
    are spread evenly over them, the rest going to the first.
    """
    parts = mixture(docs, block)
    keys = ["doc_id", "source", "mark", "size", "source_size", "target"]
    rows = texts(docs, "source").select("doc_id", F.col("source").cast("string").alias("source"), F.xxhash64("text").alias("mark"))
    sums = parts.groupBy(*keys).agg(F.sum("words").cast("long").alias("taken"), F.min("slot").alias("first_slot"))
    again = rows.groupBy("doc_id", "source", "mark").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    out = sums.alias("s").join(again.alias("a"), [F.col(f"s.{c}").eqNullSafe(F.col(f"a.{c}")) for c in ("doc_id", "source", "mark")], "left")
    out = out.withColumn("i", F.explode(F.sequence(F.lit(1).cast("long"), F.coalesce("n", F.lit(1).cast("long")))))
    n = F.coalesce(F.col("n"), F.lit(1))
    share = F.floor(F.col("taken") / n) + F.when(F.col("i") <= F.col("taken") % n, 1).otherwise(0)
    return out.select("s.doc_id", "s.size", "s.source_size", "s.target", share.cast("long").alias("taken"), "s.first_slot")


def mixed(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """``docs`` with each row as often as the mix takes it, to the nearest whole copy; all columns as they are.

    At the end of a source's line the mix takes part of a document: it counts as one
    from half of it on. Documents without words go.
    """
    keys = ["doc_id", "source", "mark"]
    rows = texts(docs, "source").select("doc_id", F.col("source").cast("string").alias("source"), F.xxhash64("text").alias("mark"))
    alike = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).alias("a")
    sums = mixture(docs, block).groupBy(*keys).agg(F.sum("words").alias("taken"), F.max("size").alias("size")).alias("s")
    plan = sums.join(alike, [F.col(f"s.{c}").eqNullSafe(F.col(f"a.{c}")) for c in keys])
    copies = F.round(F.col("taken") / (F.col("size") * F.col("n"))).cast("int")
    plan = plan.filter("size > 0").select(*[F.col(f"s.{c}").alias(f"_{c}") for c in keys], copies.alias("_copies")).filter("_copies > 0")
    own = docs.withColumn("_own", F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))))
    same = own["doc_id"].cast("long").eqNullSafe(plan["_doc_id"]) & own["source"].cast("string").eqNullSafe(plan["_source"])
    taken = own.join(plan, same & (own["_own"] == plan["_mark"]))
    taken = taken.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
    return taken.select(*[own[c] for c in docs.columns])
