"""A dataset manifest as Merkle trees, and its proofs by a recursive query.

Every row is a leaf: the SHA-256 of its columns. The leaves of a language ascend by
doc_id; every RUN consecutive nodes become one node above, until one is left, the
subroot. The subroots, ordered by language, grow a tree of the same kind, whose last
node is the root.

The built levels are stored as one row for each node above the leaves: its id, the
digests of its children one after the other, its own digest, and the id of its parent
with its place there. Ids are numbers: the level in the high bits, below it the place of
the node's first tree leaf plus its own place in the level, so that a leaf's id is its
place in the whole order and parents need no lookup. A proof is a climb along these
links: a recursive query joins each leaf to its parent, appends the siblings, folds the
digest and goes on from there, one round for all leaves of a level. Rounds need as many
joins as the highest tree has levels, that is log8 of the rows.

Defined results: a null column counts as ``-``, an empty text as ``0:``; rows of equal
doc_id are ordered by their digest, null ids first; equal rows are leaves of their own;
a null id is never tampered with; a language of one row has the leaf as its subroot; one
language has its subroot as the root, and no siblings give the digest of the empty
string; an empty table has no rows and no root. Columns beyond the five are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.llm.common import written
from riskweave.operators.ordinal import with_positions
from riskweave.session import scratch_path

RUN = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Bits of an id below its level; levels of the tree over the languages begin at TOP.
LEVEL_BITS = 56
TOP = 32
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: What a stored node is: inner, the subroot of one of several languages, the root.
INNER, SUBROOT, ROOT = 0, 1, 2

CLIMB = f"""
WITH RECURSIVE climb AS (
  SELECT leaf_id, 0 AS step, parent, slot, kind, digest, claim AS folded, CAST(NULL AS BINARY) AS siblings
  FROM {{leaves}}
  UNION ALL
  SELECT c.leaf_id, c.step + 1, n.parent, n.slot, n.kind, n.digest,
    unhex(sha2(lower(concat(
      hex(substring(n.children, 1, 32 * c.slot)), hex(c.folded), hex(substring(n.children, 32 * c.slot + 33)))), 256)),
    concat(substring(n.children, 1, 32 * c.slot), substring(n.children, 32 * c.slot + 33))
  FROM climb c JOIN {{nodes}} n ON c.parent = n.node_id
)
SELECT leaf_id,
  coalesce(max(CASE WHEN kind = {SUBROOT} THEN hex(digest) END), max(CASE WHEN kind = {ROOT} THEN hex(digest) END)) AS subroot,
  max(CASE WHEN kind = {ROOT} THEN hex(digest) END) AS root,
  max(CASE WHEN kind = {ROOT} THEN hex(folded) END) AS folded_root,
  sha2(array_join(transform(array_sort(collect_list(
    CASE WHEN step > 0 THEN struct(step, siblings) END)), s -> lower(hex(s.siblings))), ''), 256) AS proof_sha256
FROM climb GROUP BY leaf_id
"""


def digest_of(*parts: Column) -> Column:
    """SHA-256 of the concatenated strings, as 32 bytes."""
    return F.unhex(F.sha2(F.concat(*parts), 256))


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(text: Column | None = None) -> Column:
    """The digest of a row of FIELDS, or of the row with another ``text``."""
    return digest_of(*[_field(text if text is not None and f == "text" else F.col(f)) for f in FIELDS])


def _up(nodes: DataFrame, level: int) -> DataFrame:
    """The nodes of ``level`` above ``nodes`` (start, ord, n, at, digest), all with n > 1."""
    keyed = nodes.select("start", "ord", "n", F.expr(f"at div {RUN}").alias("up"), (F.col("at") % RUN).alias("slot"), "digest")
    each = F.array_sort(F.collect_list(F.struct("slot", "digest")))
    grown = keyed.groupBy("start", "ord", "n", "up").agg(
        F.unhex(F.array_join(F.transform(each, lambda c: F.hex(c["digest"])), "")).alias("children")
    )
    return grown.select(
        "start",
        "ord",
        F.expr(f"(n + {RUN - 1}) div {RUN}").alias("n"),
        F.col("up").alias("at"),
        (F.lit(level << LEVEL_BITS) + F.col("start") + F.col("up")).alias("node_id"),
        "children",
        digest_of(F.lower(F.hex("children"))).alias("digest"),
    )


def _linked(nodes: DataFrame, level: int, trees: int, top: bool) -> DataFrame:
    """``nodes`` of a level with the parent's id, the place there and what they are."""
    last = F.col("n") <= 1
    inner = F.lit((level + 1) << LEVEL_BITS) + F.col("start") + F.expr(f"at div {RUN}")
    if top or trees == 1:
        parent, slot = F.when(~last, inner), F.when(~last, F.col("at") % RUN)
    else:
        parent = F.when(~last, inner).otherwise(F.lit((TOP + 1) << LEVEL_BITS) + F.expr(f"ord div {RUN}"))
        slot = F.when(~last, F.col("at") % RUN).otherwise(F.col("ord") % RUN)
    kind = F.when(~last, INNER).otherwise(ROOT if top or trees == 1 else SUBROOT)
    return nodes.withColumns({"parent": parent, "slot": slot.cast("int"), "kind": kind})


def _levels(nodes: DataFrame, level: int, trees: int, top: bool, path: str) -> DataFrame:
    """Write all levels above ``nodes`` (start, ord, n, at, digest), each made from the written one below.

    Returns the last node of every tree, (ord, digest).
    """
    spark = nodes.sparkSession
    lasts = nodes.filter("n = 1").select("ord", "digest")
    most = nodes.agg(F.max("n").alias("most")).first()["most"] or 0
    while most > 1:
        level, most = level + 1, -(-most // RUN)
        folder = f"{path}/level={level}"
        _linked(_up(nodes.filter("n > 1"), level), level, trees, top).write.parquet(folder)
        nodes = spark.read.parquet(folder)
        lasts = lasts.union(nodes.filter("n = 1").select("ord", "digest"))
    return lasts


def write_manifest(docs: DataFrame, path: str) -> None:
    """Write the trees of ``docs`` under ``path``: ``leaves`` and ``nodes``.

    ``leaves``: leaf_id, doc_id, digest, tampered (a digest for a third of the ids, else
    null), parent, slot, kind. ``nodes``: node_id, children, digest, parent, slot, kind.
    """
    rows = docs.select(*[F.col(f) for f in FIELDS])
    tree = F.when(F.col("lang").isNull(), "").otherwise(F.concat(F.lit("="), F.col("lang")))
    chosen = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, F.lit(False))
    # Texts are read once and end here: only digests are ordered.
    hashed = rows.select(
        tree.alias("tree"),
        F.col("doc_id").cast("long").alias("doc_id"),
        leaf_digest().alias("digest"),
        F.when(chosen, leaf_digest(F.translate("text", CAPITALS, CAPITALS.lower()))).alias("tampered"),
    )
    hashed = written(hashed, "digests")
    placed = written(with_positions(hashed, ["tree", F.col("doc_id").asc_nulls_first(), "digest"], "leaf_id"), "leaves")
    trees = placed.groupBy("tree").agg(F.min("leaf_id").alias("start"), F.count(F.lit(1)).alias("n"))
    trees = written(with_positions(trees, ["tree"], "ord"), "trees")
    many = trees.count()
    leaves = placed.join(trees, "tree").withColumn("at", F.col("leaf_id") - F.col("start"))
    stored = _linked(leaves, 0, many, top=False).drop("tree")
    stored.write.parquet(f"{path}/leaves")
    nodes = docs.sparkSession.read.parquet(f"{path}/leaves").select("start", "ord", "n", "at", "digest")
    lasts = _levels(nodes, 0, many, False, f"{path}/nodes")
    if many > 1:
        zero, n = F.lit(0).cast("long"), F.lit(many).cast("long")
        subroots = lasts.select(zero.alias("start"), zero.alias("ord"), n.alias("n"), F.col("ord").alias("at"), "digest")
        _levels(written(subroots, "subroots"), TOP, 1, True, f"{path}/nodes")


def read_manifest(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(leaves, nodes) as :func:`write_manifest` wrote them; no node where each leaf is its own root."""
    leaves = spark.read.parquet(f"{path}/leaves")
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/nodes")
    names = "node_id", "children", "digest", "parent", "slot", "kind"
    if folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return leaves, spark.read.option("basePath", f"{path}/nodes").parquet(f"{path}/nodes").select(*names)
    return leaves, spark.createDataFrame([], "node_id long, children binary, digest binary, parent long, slot int, kind int")


def climb(leaves: DataFrame, nodes: DataFrame, claim: Column) -> DataFrame:
    """(leaf_id, subroot, root, proof_sha256, folded_root), all hexadecimal, of every leaf.

    The digest ``claim``, a column of ``leaves``, is folded with the stored siblings.
    """
    spark = leaves.sparkSession
    spark.conf.set("spark.sql.cteRecursionRowLimit", "-1")  # as many rows as the climb has
    asked = leaves.select("leaf_id", "parent", "slot", "kind", "digest", claim.alias("claim"))
    return spark.sql(CLIMB, leaves=asked, nodes=nodes)


def manifest(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Write the manifest of ``docs`` and check every row against it, a third of them tampered with.

    (doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of each row.
    """
    spark = docs.sparkSession
    path = path or scratch_path(spark, "merkle")
    write_manifest(docs, path)
    leaves, nodes = read_manifest(spark, path)
    proved = climb(leaves, nodes, F.coalesce("tampered", "digest"))
    low = lambda c: F.lower(F.col(c))
    out = leaves.select("leaf_id", "doc_id", "digest").join(proved, "leaf_id")
    return out.select(
        "doc_id",
        F.lower(F.hex("digest")).alias("leaf"),
        low("subroot").alias("subroot"),
        low("root").alias("root"),
        "proof_sha256",
        low("folded_root").alias("folded_root"),
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )
