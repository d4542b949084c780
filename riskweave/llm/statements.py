"""Checking SQL of the operators that DuckDB can express over the same tables."""

from __future__ import annotations

from riskweave.llm.merkle import CAPITALS

#: CRC-32 of a list of bytes, bit by bit. 3988292384 is its reflected polynomial.
_BIT = "CASE WHEN d & 1 = 1 THEN xor(d >> 1, 3988292384) ELSE d >> 1 END"
_CRC = (
    "xor(list_reduce(list_transform(string_split({0}, ''), lambda x: CAST(ascii(x) AS BIGINT)), "
    f"lambda c, b: list_reduce(range(8), lambda d, k: {_BIT}, xor(c, b)), CAST(4294967295 AS BIGINT)), 4294967295)"
)


def _field(name: str) -> str:
    return f"coalesce(CAST(strlen(CAST({name} AS VARCHAR)) AS VARCHAR) || ':' || CAST({name} AS VARCHAR), '-')"


_LEAF = " || ".join(_field(f) for f in ("doc_id", "source", "lang", "n_chars"))
_SMALL = f"translate(text, '{CAPITALS}', '{CAPITALS.lower()}')"


def _sides(table: str) -> str:
    """The nodes of a tree that have a node above, with what stands left and right of them in their run."""
    run = "OVER (PARTITION BY tree, level, place // 8 ORDER BY place ROWS BETWEEN"
    left = f"coalesce(string_agg(digest, '') {run} UNBOUNDED PRECEDING AND 1 PRECEDING), '')"
    right = f"coalesce(string_agg(digest, '') {run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '')"
    return f"SELECT tree, level, place, {left} AS l, {right} AS r FROM {table} WHERE n > 1"


def _grown(table: str, start: str) -> str:
    """The levels of a tree, each node the digest of 8 below."""
    return f"""{start} UNION ALL
  SELECT tree, level + 1, place // 8, (n + 7) // 8, sha256(string_agg(digest, '' ORDER BY place)) FROM {table} WHERE n > 1 GROUP BY tree, level, n, place // 8"""


def _climb(table: str, sides: str, start: str) -> str:
    return f"""{start} UNION ALL
  SELECT c.leaf_no, c.tree, c.level + 1, c.place // 8, sha256(s.l || c.folded || s.r), c.sibs || s.l || s.r
  FROM {table} c JOIN {sides} s ON s.tree = c.tree AND s.level = c.level AND s.place = c.place"""


MERKLE_SQL = f"""
WITH RECURSIVE digests AS (
  SELECT doc_id, lang, sha256({_LEAF} || {_field('text')}) AS leaf,
    CASE WHEN {_CRC.format("CAST(doc_id AS VARCHAR)")} % 3 = 0 THEN sha256({_LEAF} || {_field(_SMALL)}) END AS changed
  FROM documents
), trees AS (
  SELECT lang, CAST(row_number() OVER (ORDER BY lang NULLS FIRST) AS BIGINT) - 1 AS tree, count(*) AS n FROM digests GROUP BY lang
), leaves AS (
  SELECT d.*, t.tree, t.n, row_number() OVER (ORDER BY t.tree, doc_id NULLS FIRST, leaf) AS leaf_no,
    row_number() OVER (PARTITION BY t.tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place
  FROM digests d JOIN trees t ON d.lang IS NOT DISTINCT FROM t.lang
), built AS (
  {_grown("built", "SELECT tree, 0 AS level, place, n, leaf AS digest FROM leaves")}
), tops AS (
  {_grown("tops", "SELECT 0 AS tree, 0 AS level, tree AS place, (SELECT count(*) FROM trees) AS n, digest FROM built WHERE n = 1")}
), low_sides AS ({_sides("built")}), top_sides AS ({_sides("tops")}
), low AS (
  {_climb("low", "low_sides", "SELECT leaf_no, tree, 0 AS level, place, coalesce(changed, leaf) AS folded, '' AS sibs FROM leaves")}
), arrived AS (
  SELECT leaf_no, tree, folded, sibs FROM low QUALIFY row_number() OVER (PARTITION BY leaf_no ORDER BY level DESC) = 1
), top AS (
  {_climb("top", "top_sides", "SELECT leaf_no, 0 AS tree, 0 AS level, tree AS place, folded, sibs FROM arrived")}
), ended AS (
  SELECT leaf_no, folded, sibs FROM top QUALIFY row_number() OVER (PARTITION BY leaf_no ORDER BY level DESC) = 1
)
SELECT l.doc_id, l.leaf, b.digest AS subroot, t.digest AS root, sha256(e.sibs) AS proof_sha256,
  e.folded AS folded_root, e.folded = t.digest AS verified
FROM leaves l JOIN ended e ON e.leaf_no = l.leaf_no JOIN built b ON b.tree = l.tree AND b.n = 1 JOIN tops t ON t.n = 1
"""

COSINE_SQL = """
WITH RECURSIVE vectors AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE len(list_filter(CAST(embedding AS DOUBLE[]), lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(CAST(embedding AS DOUBLE[]), lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM vectors a JOIN vectors b ON a.vec_id <> b.vec_id
  WHERE CASE WHEN len(a.e) = len(b.e) THEN list_cosine_similarity(a.e, b.e) END >= 0.95
), reach AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings
  UNION
  SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), components AS (
  SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a
)
SELECT c.vec_id, (SELECT count(*) FROM links l WHERE l.a = c.vec_id) AS n_links, c.component_id, c.vec_id = c.component_id AS kept
FROM components c
"""

#: CRC-32 is linear: the bytes' shares, by their distance from the end, are combined by xor.
SPELLING_SQL = f"""
WITH RECURSIVE table_of AS (
  SELECT b, list_reduce(range(8), lambda d, k: {_BIT}, b) AS v FROM range(256) r(b)
), found AS (
  SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\\x{{00C0}}-\\x{{00FF}}]+')) AS run FROM documents
), runs AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') || ':' AS head, translate(run, '{CAPITALS}', '{CAPITALS.lower()}') AS run, count(*) AS n
  FROM found WHERE length(run) >= 5 GROUP BY ALL
), longest AS (
  SELECT max(strlen(run)) AS len FROM runs
), shares AS (
  SELECT 0 AS dist, b, v FROM table_of
  UNION ALL
  SELECT s.dist + 1, s.b, xor(s.v >> 8, t.v) FROM shares s JOIN table_of t ON t.b = s.v & 255
  WHERE s.dist < (SELECT max(len) + 24 FROM longest)
), coded AS (
  SELECT *, hex(encode(head || run)) AS code, strlen(head || run) AS size FROM runs
), bytes AS (
  SELECT head, run, size, i, CAST('0x' || substr(code, CAST(2 * i + 1 AS INT), 2) AS BIGINT) AS byte
  FROM (SELECT *, unnest(range(size)) AS i FROM coded)
), hashed AS (
  SELECT head, run, xor(bit_xor(s.v), 4294967295) AS h
  FROM bytes b JOIN shares s ON s.dist = b.size - 1 - b.i AND s.b = CASE WHEN b.i < 4 THEN xor(b.byte, 255) ELSE b.byte END
  GROUP BY head, run
), changed AS (
  SELECT r.n, CASE WHEN h % 97 = 0
    THEN left(r.run, CAST(h % length(r.run) AS INT)) || substr(r.run, CAST(h % length(r.run) AS INT) + 2) ELSE r.run END AS word
  FROM runs r JOIN hashed USING (head, run)
), words AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM changed WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3
), less AS (
  SELECT word, n, i, left(word, CAST(i AS INT)) || substr(word, CAST(i AS INT) + 2) AS rest
  FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)
), near AS (
  SELECT a.word, b.word AS other, b.n FROM less a JOIN less b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION
  SELECT a.word, b.word, b.n FROM less a JOIN words b ON a.rest = b.word
  UNION
  SELECT b.word, a.word, a.n FROM less a JOIN words b ON a.rest = b.word
), best AS (
  SELECT word, count(*) AS n_near, first(other ORDER BY n DESC, encode(other)) AS other, max(n) AS other_n FROM near GROUP BY word
), forms AS (
  SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN other_n >= 2 * w.n THEN other END AS form,
    CASE WHEN other_n >= 2 * w.n THEN other_n END AS form_n
  FROM words w LEFT JOIN best b ON b.word = w.word
), followed AS (
  SELECT word, word AS at FROM forms
  UNION ALL
  SELECT f.word, g.form FROM followed f JOIN forms g ON g.word = f.at WHERE g.form IS NOT NULL
), roots AS (
  SELECT f.word, f.at AS root FROM followed f JOIN forms g ON g.word = f.at WHERE g.form IS NULL
)
SELECT f.word, f.form, r.root, f.n, f.n_near, f.form_n FROM forms f JOIN roots r ON r.word = f.word
"""
