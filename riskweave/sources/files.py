"""Readers: delivered CSV trees, headers, encodings, event lines."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Sequence

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from riskweave import rules
from riskweave.functions.clean import clean_columns, clean_column_name
from riskweave.functions.timeparse import parse_time

# A date inside a file path, and a month file name.
DATE_TOKEN = r"(\d{4})[-_]?([01]\d)[-_]?([0-3]\d)"
MONTH_FILE = r"(\d{4})-(\d{2})\.csv$"

# Bytes of a text line in GBK, as hex: ASCII, or a lead byte and a trail byte.
_GBK = r"^(?:[0-7][0-9A-F]|(?:8[1-9A-F]|[9A-E][0-9A-F]|F[0-9A-E])(?:[4-6][0-9A-F]|7[0-9A-E]|[89A-E][0-9A-F]|F[0-9A-E]))*+$"


def list_csv_files(spark: SparkSession, path: str) -> DataFrame:
    """CSV files of a file or directory tree with their date token. Content is not read."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.csv")
        .load(path)
        .select("path", "length")
    )
    return files.withColumn("date_token", date_token(F.col("path")))


def date_token(path: Column) -> Column:
    """``YYYYMMDD`` from the first date in a path, NULL without one."""
    parts = [F.regexp_extract(path, DATE_TOKEN, i) for i in (1, 2, 3)]
    return F.when(path.rlike(DATE_TOKEN), F.concat(*parts))


def file_order(path: Column) -> list[Column]:
    """Sort key of files: by date token, undated last, then by path."""
    return [date_token(path).asc_nulls_last(), path.asc()]


def _reader(spark: SparkSession, encoding: str):
    return (
        spark.read.option("header", "true")
        .option("inferSchema", "false")
        .option("enforceSchema", "false")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.csv")
        .option("escape", '"')
        .option("encoding", encoding)
    )


def read_feed(spark: SparkSession, path: str | Sequence[str], encoding: str = "UTF-8") -> DataFrame:
    """All-string rows of a CSV tree with clean headers.

    Files of one call share a header; a file that differs raises instead of being
    read by position. See :func:`read_mixed_feed` for trees of several layouts.
    """
    paths = [path] if isinstance(path, str) else list(path)
    if encoding != "GBK":
        return clean_columns(_reader(spark, encoding).csv(paths))
    # Spark has no GBK reader. No byte of a GBK character is a comma, a quote or a line
    # end, so rows are parsed byte by byte and the texts decoded after that.
    raw = _reader(spark, "ISO-8859-1").csv(paths)
    names = [c.encode("latin-1").decode("gbk") for c in raw.columns]
    return clean_columns(raw.select(*[gbk_text(F.col(f"`{c}`")).alias(n) for c, n in zip(raw.columns, names)]))


def gbk_text(text: Column) -> Column:
    """GBK text from its bytes as Latin-1 characters."""

    @F.pandas_udf(StringType())
    def decoded(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: t.encode("latin-1").decode("gbk"), na_action="ignore")

    return decoded(text)


def read_mixed_feed(spark: SparkSession, path: str) -> DataFrame:
    """A CSV tree whose files differ in encoding or header: one scan per combination."""
    found = file_encodings(spark, path).join(file_headers(spark, path), "path")
    groups: dict[tuple, list[str]] = defaultdict(list)
    # One short row per file: the driver plans a scan from the same list of files.
    for row in found.select("path", "encoding", "header").toLocalIterator():
        groups[(row.encoding, tuple(row.header))].append(row.path)
    parts = [read_feed(spark, sorted(paths), encoding) for (encoding, _), paths in sorted(groups.items())]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out


def read_or_empty(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """The named columns of a feed, or no rows when it was not delivered."""
    try:
        return read_feed(spark, path).select(*columns)
    except AnalysisException as err:
        if "PATH_NOT_FOUND" not in (err.getCondition() or ""):
            raise
        return spark.createDataFrame([], ", ".join(f"{c} string" for c in columns))


def read_month(df: DataFrame, columns: Sequence[str], time_column: str) -> DataFrame:
    """Projected scan with the time parsed and rows of bad time dropped."""
    out = df.select(*[parse_time(df, c).alias(c) if c == time_column else F.col(c) for c in columns])
    return out.dropna(subset=[time_column])


def load_labels(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Label table: named columns, missing text as blank."""
    return df.select(*[F.col(c).cast("string") for c in columns]).na.fill("")


# -- per-file facts -----------------------------------------------------------


def _lines(spark: SparkSession, path: str | list[str], glob: str = "*") -> DataFrame:
    """Raw lines with their place: file, split start, running id inside the scan."""
    return (
        spark.read.option("recursiveFileLookup", "true")
        .option("pathGlobFilter", glob)
        .text(path)
        .select(
            "value",
            F.col("_metadata.file_path").alias("path"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("id"),
        )
    )


def file_encodings(spark: SparkSession, path: str) -> DataFrame:
    """Encoding per CSV file: UTF-8 if every byte fits, else GBK, else Latin-1.

    Lines are checked where they are scanned; no file has to fit in a task.
    """
    raw = F.hex(F.col("value").cast("binary"))
    per_file = (
        _lines(spark, path, "*.csv")
        .groupBy("path")
        .agg(F.bool_and(F.is_valid_utf8("value")).alias("utf8"), F.bool_and(raw.rlike(_GBK)).alias("gbk"))
    )
    return per_file.select(
        "path", F.when(F.col("utf8"), "UTF-8").when(F.col("gbk"), "GBK").otherwise("ISO-8859-1").alias("encoding")
    )


def file_headers(spark: SparkSession, path: str) -> DataFrame:
    """Clean header names per CSV file."""
    first = (
        _lines(spark, path, "*.csv")
        .filter(F.col("block") == 0)
        .groupBy("path")
        .agg(F.min_by("value", "id").alias("line"))
    )
    names = F.transform(
        F.split(F.regexp_replace("line", "\ufeff|\r", ""), ","),
        lambda c: F.lower(F.btrim(F.regexp_replace(c, r'^\s*"|"\s*$', ""), F.lit(rules.WHITESPACE))),
    )
    return first.select("path", names.alias("header"))


def header_catalogue(spark: SparkSession, root: str, datasets: Sequence[str]) -> DataFrame:
    """Header of the first CSV file, by path, of each dataset folder."""
    files = list_csv_files(spark, root)
    dataset = F.regexp_extract("path", "/(" + "|".join(datasets) + ")/", 1)
    firsts = files.groupBy(dataset.alias("dataset")).agg(F.min("path").alias("path")).filter("dataset <> ''")
    paths = {r.path: r.dataset for r in firsts.collect()}  # one row per dataset
    parts = [file_headers(spark, p).withColumn("dataset", F.lit(d)) for p, d in sorted(paths.items())]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.select("dataset", "path", "header")


def validate_headers(headers: DataFrame) -> DataFrame:
    """Check ``dataset, path, header`` rows against the column rules."""
    spark = headers.sparkSession
    rows = [
        (d, [clean_column_name(c) for c in cols], rules.REQUIRED_ANY_OF.get(d, []))
        for d, cols in rules.REQUIRED_COLUMNS.items()
    ]
    known = spark.createDataFrame(rows, "dataset string, required array<string>, any_of array<array<string>>")
    missing = F.array_except("required", "header")
    unmet = F.filter("any_of", lambda group: ~F.arrays_overlap(group, F.col("header")))
    checked = headers.join(F.broadcast(known), "dataset", "left").select(
        "dataset",
        "path",
        F.coalesce(missing, F.array().cast("array<string>")).alias("missing"),
        F.coalesce(unmet, F.array().cast("array<array<string>>")).alias("missing_any_of"),
    )
    return checked.withColumn("ok", (F.size("missing") == 0) & (F.size("missing_any_of") == 0))


# -- event lines --------------------------------------------------------------


def _below(spark: SparkSession, root: str) -> Column:
    """``path`` relative to a root folder, so that equal names in two folders are two files; a root that is a file keeps its name."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(root)
    uri = folder.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(folder).toUri()
    place = F.regexp_replace("path", r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "")
    below = F.element_at(F.split("path", "/"), -1)
    for whole in {f"{uri.getPath().rstrip('/')}/", f"{uri.getRawPath().rstrip('/')}/"}:
        below = F.when(F.startswith(place, F.lit(whole)), F.substr(place, F.lit(len(whole) + 1))).otherwise(below)
    return below


def list_event_files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """(file, path, length) of the files of a folder, ``file`` being the path below it. Content is not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(path)
    return files.select(_below(spark, path).alias("file"), "path", "length")


def numbered_lines(spark: SparkSession, path: str | list[str], glob: str = "*", root: str | None = None) -> DataFrame:
    """Text lines with the file's path below ``root`` and line number, blank lines left out but counted.

    ``root`` is ``path`` unless given; a list of paths needs it. Lines number themselves inside their split; splits of a
    file add the lines of the splits before them, a table of one row per split.
    """
    return number_lines(_lines(spark, path, glob), _below(spark, root or path))


def number_lines(lines: DataFrame, file: Column) -> DataFrame:
    """``file``, ``line`` and ``value`` of raw lines (value, path, block, id) whose ids grow inside a split."""
    blocks = lines.groupBy("path", "block").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.select("path", "block", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    # One row for each split: joined any other way, the lines of a split would meet in one task.
    numbered = lines.join(F.broadcast(starts), ["path", "block"]).select(
        file.alias("file"),
        (F.col("before") + F.col("id") - F.col("first") + 1).alias("line"),
        "value",
    )
    return numbered.filter(F.btrim("value", F.lit(rules.WHITESPACE)) != "")


def blank_lines(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """The number of blank lines, as one row."""
    blank = F.btrim("value", F.lit(rules.WHITESPACE)) == ""
    return spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", glob).text(path).agg(F.count_if(blank).alias("n"))


EVENT_SCHEMA = "type string, ts string, data map<string,string>, id_type string, id_value string, labels string"


def parse_events(lines: DataFrame) -> DataFrame:
    """Event columns of JSON lines; ``corrupt`` holds lines that are no event object."""
    schema = EVENT_SCHEMA + ", corrupt string"
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "corrupt"}
    kept = [c for c in lines.columns if c != "value"]
    event = F.from_json("value", schema, options)
    return lines.select(*kept, "value", event.alias("e")).select(
        *kept,
        "e.type",
        "e.ts",
        "e.data",
        "e.id_type",
        "e.id_value",
        "e.labels",
        F.when(F.col("e").isNull() | F.col("e.corrupt").isNotNull(), F.col("value")).alias("corrupt"),
    )


def after_checkpoint(lines: DataFrame, file: str | None, line: int = 0) -> DataFrame:
    """Lines after the last processed (file, line), files in the order of their paths."""
    if file is None:
        return lines
    later = (F.col("file") > file) | ((F.col("file") == file) & (F.col("line") > line))
    return lines.filter(later)
