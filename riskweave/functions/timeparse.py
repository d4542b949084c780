"""Lenient time parsing and formatting. All times are zone-less and mean UTC."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskweave.functions.clean import clean_text

# The range of a nanosecond timestamp; times outside it are invalid.
MIN_TIME = "1677-09-21 00:12:43.145224"
MAX_TIME = "2262-04-11 23:47:16.854775"

_ZONE = r"\d{2}:\d{2}.*([zZ]|[+-]\d{2}:?\d{2})$"
_SLASHED = r"^(\d{4})/(\d{1,2})/(\d{1,2})"
_COMPACT = r"^(\d{4})(\d{2})(\d{2})(?=$|[ T])"


def parse_text_time(c: Column | str) -> Column:
    """Text to ``timestamp_ntz``; NULL when it does not parse. Offsets convert to UTC."""
    t = clean_text(c)
    t = F.regexp_replace(t, _SLASHED, "$1-$2-$3")
    t = F.regexp_replace(t, _COMPACT, "$1-$2-$3")
    zoned = F.convert_timezone(
        F.current_timezone(), F.lit("UTC"), t.try_cast("timestamp_ltz").cast("timestamp_ntz")
    )
    ts = F.when(t.rlike(_ZONE), zoned).otherwise(t.try_cast("timestamp_ntz"))
    return F.when(ts.between(_ntz(MIN_TIME), _ntz(MAX_TIME)), ts)


def _ntz(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def parse_time(df: DataFrame, name: str) -> Column:
    """``df[name]`` as ``timestamp_ntz``, whatever its type."""
    dtype = df.schema[name].dataType
    if isinstance(dtype, T.TimestampNTZType):
        return F.col(name)
    if isinstance(dtype, (T.TimestampType, T.DateType)):
        return F.col(name).cast("timestamp_ntz")
    return parse_text_time(name)


def first_existing_time(df: DataFrame, candidates: Iterable[str]) -> Column:
    """Time of the first candidate that is a column of ``df``."""
    for name in candidates:
        if name in df.columns:
            return parse_time(df, name)
    return F.lit(None).cast("timestamp_ntz")


def first_parsed_time(df: DataFrame, candidates: Iterable[str]) -> Column:
    """First candidate column that parses."""
    present = [parse_time(df, name) for name in candidates if name in df.columns]
    return F.coalesce(*present) if present else F.lit(None).cast("timestamp_ntz")


def iso_text(c: Column | str) -> Column:
    """ISO text; the fraction appears only when it is not zero."""
    t = F.col(c) if isinstance(c, str) else c
    whole = F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss")
    return F.when(F.date_format(t, "SSSSSS") == "000000", whole).otherwise(
        F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    )


def month_text(c: Column | str) -> Column:
    return F.date_format(c, "yyyy-MM")


def day_text(c: Column | str) -> Column:
    return F.date_format(c, "yyyy-MM-dd")


def seconds_between(start: Column, end: Column) -> Column:
    """Seconds from ``start`` to ``end`` as double, microsecond exact."""
    return F.timestamp_diff("MICROSECOND", start, end) / F.lit(1e6)
