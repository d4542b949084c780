"""Secret scans: fixed patterns, and a battery of randomness tests.

The battery looks at every run of 20 or more characters of encoded data, '=' only at its
end and the spans of fixed patterns cut out. It infers the smallest alphabet that holds the run and tests whether its characters are as random as a
key's: a chi-squared test of uniformity, a runs test about the middle of the alphabet and
a test of the serial correlation of neighbours, joined by Fisher's method. What is not
random, long words, paths and tables, is told apart from keys by false-discovery control:
the runs of a length class over *all* texts form one Benjamini-Hochberg family, because
short runs have less power than long ones. Runs that stay compatible with randomness,
carry at least MIN_BITS bits and mix digits with letters become spans of kind ``random``.

Defined results: null and empty texts have no spans; rows are judged one by one (the
thresholds come from all of them), so that repeated rows, ties and null ids keep their
rows; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.llm.common import batches, bounded_batches, record_batch, texts, written

#: The base patterns and their least lengths.
ASSIGN = re.compile(r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ASSIGN_LEAST = 6
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
ACCESS_LEAST = 20
HEX_LEAST = 24
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "random")

#: Runs that the battery tests, and what it asks of them.
RUN_LEAST = 20
RUN = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
#: Encoded data holds '=' only as padding at its end, so that NAME=value is two parts.
PART = re.compile(r"[A-Za-z0-9+/_-]+=*")
#: What may join a part to a base span beside it.
JOINS = "/_-"
MIN_BITS = 64
FALSE_DISCOVERY = 0.05
#: Length classes start here; p-values are counted in bins of a tenth of -log10 p.
CLASSES = (20, 28, 40, 64, 128, 256)
BINS = 200

ALPHABETS = [
    "0123456789",
    "0123456789abcdef",
    "0123456789ABCDEF",
    "abcdefghijklmnopqrstuvwxyz",
    "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "0123456789abcdefghijklmnopqrstuvwxyz",
    "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz",
    "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
    "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_",
    "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/-_",
]
SETS = [frozenset(a) for a in ALPHABETS]
PLACES = [{c: i for i, c in enumerate(a)} for a in ALPHABETS]

_RUN_CHARS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
#: Byte tables that mark the characters of runs, to find them without a pattern.
IS_RUN = bytes(120 if chr(i) in _RUN_CHARS else 32 for i in range(256))
IS_HEX = bytes(120 if chr(i) in "0123456789abcdef" else 32 for i in range(256))
NAMES = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")

SPAN = pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64()), ("length_class", pa.int32()), ("bin", pa.int32())])
FOUND = pa.schema([("doc_id", pa.int64()), ("base", pa.list_(SPAN)), ("runs", pa.list_(SPAN))])
SPAN_DDL = "array<struct<kind int, start long, end long, length_class int, bin int>>"


def base_spans(text: str, raw: bytes) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the fixed patterns, by start, then kind."""
    found = []
    low = raw.lower()
    if any(n in low for n in NAMES):
        found += [(0, m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    if b"AKIA" in raw:
        found += [(1, m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    if b"x" * HEX_LEAST in raw.translate(IS_HEX):
        found += [(2, m.start(), m.end()) for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[1], s[0]))


def randomness(run: str) -> tuple[float, float]:
    """(p, bits): the battery's joint p-value of ``run`` and the bits it can carry."""
    body = run.rstrip("=")
    chars = frozenset(body)
    k = next((i for i, s in enumerate(SETS) if chars <= s), None)
    if k is None or len(body) < 4:
        return 0.0, 0.0
    size, n = len(ALPHABETS[k]), len(body)
    at = np.array([PLACES[k][c] for c in body], dtype=np.float64)
    upper = lambda z: 0.5 * math.erfc(z / math.sqrt(2))
    counts = np.bincount(at.astype(np.int64), minlength=size)
    chi = float(((counts - n / size) ** 2).sum() * size / n)
    spread = math.sqrt(2 * (size - 1) * max(n - 1, 1) / n)
    p_uniform = upper((chi - (size - 1)) / spread)
    high = at >= size / 2
    ups, downs = int(high.sum()), int((~high).sum())
    p_runs = 2.0 ** (1 - n) if not ups or not downs else 1.0
    if ups and downs:
        runs = 1 + int((high[1:] != high[:-1]).sum())
        mean = 2 * ups * downs / n + 1
        var = (mean - 1) * (mean - 2) / (n - 1)
        p_runs = 2 * upper(abs(runs - mean) / math.sqrt(var)) if var > 0 else 1.0
    shifted = at - at.mean()
    power = float((shifted**2).sum())
    serial = float((shifted[1:] * shifted[:-1]).sum()) / power if power else 1.0
    p_serial = 2 * upper(abs(serial + 1 / n) * math.sqrt(n))
    half = -sum(math.log(max(p, 1e-300)) for p in (p_uniform, p_runs, p_serial))
    return math.exp(-half) * (1 + half + half * half / 2), n * math.log2(size)


def mixed(run: str) -> bool:
    return any(c.isdigit() for c in run) and any(c.isalpha() for c in run)


def parts(text: str, start: int, end: int, base: list[tuple[int, int, int]]) -> Iterator[tuple[int, int]]:
    """(start, end) of the parts of a run that are left when the base spans are cut out.

    One separator that joined a part to a base span goes with the cut.
    """
    holes = sorted((s, e) for _, s, e in base if s < end and start < e)
    left, cut = start, False
    for s, e in [*holes, (end, end)]:
        right = min(s, end)
        if left < right:
            first, last = left, right
            if cut and text[first] in JOINS:
                first += 1
            if s < end and first < last and text[last - 1] in JOINS:
                last -= 1
            for m in PART.finditer(text, first, last):
                if m.end() - m.start() >= RUN_LEAST:
                    yield m.span()
        if e > left:
            left, cut = e, True


def tested_runs(text: str, raw: bytes, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int, int, int]]:
    """(kind, start, end, length class, bin) of each tested part of a run; none overlaps a base span.

    A part that cannot become a span is tested as well: it belongs to the family.
    """
    if b"x" * RUN_LEAST not in raw.translate(IS_RUN):
        return []
    out = []
    for m in RUN.finditer(text):
        for start, end in parts(text, *m.span(), base):
            part = text[start:end]
            p, bits = randomness(part)
            able = bits >= MIN_BITS and mixed(part)
            bin_ = min(BINS - 1, int(-10 * math.log10(max(p, 1e-300))))
            kind = 3 if able else -1
            length_class = max(i for i, least in enumerate(CLASSES) if end - start >= least)
            out.append((kind, start, end, length_class, bin_))
    return out


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, base, runs): the base spans and the tested runs of each row."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        struct = lambda s: dict(zip(("kind", "start", "end", "length_class", "bin"), (*s, 0, 0)))
        for ids, found in batches(rows):
            base, runs = [], []
            for text in found:
                raw = text.encode()
                b = base_spans(text, raw)
                base.append([struct(s) for s in b])
                runs.append([struct(s) for s in tested_runs(text, raw, b)])
            yield record_batch(FOUND, ids, base, runs)

    return texts(docs).mapInArrow(run, f"doc_id long, base {SPAN_DDL}, runs {SPAN_DDL}")


def rejected_from(scanned: DataFrame) -> list[int]:
    """For each length class the first bin whose runs are told apart from random ones.

    Benjamini-Hochberg on binned p-values; at most len(CLASSES) * BINS counts reach the
    driver, however many runs there are.
    """
    runs = scanned.select(F.explode("runs").alias("r")).select("r.length_class", "r.bin")
    counts = np.zeros((len(CLASSES), BINS), dtype=np.int64)
    for r in runs.groupBy("length_class", "bin").count().collect():
        counts[r["length_class"], r["bin"]] = r["count"]
    out = []
    for c in counts:
        total, as_small = int(c.sum()), np.cumsum(c[::-1])[::-1]
        # A bin's largest p-value is 10 ** (-bin / 10).
        hits = [b for b in range(BINS) if c[b] and 10 ** (-b / 10) <= FALSE_DISCOVERY * as_small[b] / max(total, 1)]
        out.append(min(hits, default=BINS))
    return out


def _kept_runs(limits: list[int]) -> Column:
    limit = F.array(*[F.lit(x) for x in limits])
    return F.filter("runs", lambda r: (r["kind"] == 3) & (r["bin"] < F.element_at(limit, r["length_class"] + 1)))


def secret_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, n_random, base_sha256, spans) of each row.

    Spans are kind:start:end in code points, by start, then kind.
    """
    scanned = written(scan(docs), "secrets")
    limits = rejected_from(scanned)
    pick = F.array(*[F.lit(k) for k in KINDS])
    shown = lambda a: F.array_join(
        F.transform(a, lambda s: F.concat_ws(":", F.element_at(pick, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ","
    )
    by = lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"))
    every = F.array_sort(F.transform(F.concat("base", _kept_runs(limits)), by))
    n = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return scanned.select(
        "doc_id",
        n(0).alias("n_assign"),
        n(1).alias("n_access"),
        n(2).alias("n_hex"),
        F.size(_kept_runs(limits)).cast("long").alias("n_random"),
        F.sha2(shown(F.col("base")), 256).alias("base_sha256"),
        shown(every).alias("spans"),
    )


def redacted(docs: DataFrame, mask: str = "[secret]") -> DataFrame:
    """``docs`` with every span of every text replaced by ``mask``; n_chars, if there, is the new length.

    Other columns stay as they are; a null text stays null. The limits of the battery
    come from all rows first; the second pass finds the same spans again.
    """
    limits = rejected_from(scan(docs))
    names = docs.schema.fieldNames()
    at = names.index("text")

    def clean(text: str) -> str:
        raw = text.encode()
        base = base_spans(text, raw)
        spans = [(s, e) for _, s, e in base]
        spans += [(s, e) for kind, s, e, c, b in tested_runs(text, raw, base) if kind == 3 and b < limits[c]]
        out, last = [], 0
        for start, end in sorted(spans):
            if start >= last:
                out += [text[last:start], mask]
            last = max(last, end)
        return "".join(out) + text[last:] if spans else text

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            column = batch.column(at)
            new = pa.array([None if t is None else clean(t) for t in column.to_pylist()], type=column.type)
            yield pa.RecordBatch.from_arrays([new if i == at else c for i, c in enumerate(batch.columns)], schema=batch.schema)

    bounded_batches(docs.sparkSession)
    out = docs.mapInArrow(run, docs.schema)
    if "n_chars" in names:
        out = out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return out
