"""Text and key normalisation as column expressions."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskweave import rules


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_text(c: Column | str) -> Column:
    """Trim; the null tokens in any case become NULL."""
    trimmed = F.btrim(_col(c).cast("string"), F.lit(rules.WHITESPACE))
    return F.when(~F.lower(trimmed).isin(*rules.NULL_TOKENS), trimmed)


def clean_key(c: Column | str) -> Column:
    """Graph key: cleaned text in lower case."""
    return F.lower(clean_text(c))


def clean_device(c: Column | str, placeholders: Sequence[str] = rules.PLACEHOLDER_DEVICES) -> Column:
    """Device key, NULL for the placeholder values."""
    key = clean_key(c)
    return F.when(~key.isin(*placeholders), key)


def trim_only(c: Column | str) -> Column:
    """First-generation rule: trim, blank becomes NULL, no null tokens."""
    trimmed = F.btrim(_col(c).cast("string"), F.lit(rules.WHITESPACE))
    return F.when(trimmed != "", trimmed)


def strip_quotes(c: Column | str) -> Column:
    """Trim, then drop one pair of surrounding double quotes; a text without one meets no pattern."""
    trimmed = F.btrim(_col(c).cast("string"), F.lit(rules.WHITESPACE))
    return F.when(F.startswith(trimmed, F.lit('"')), F.regexp_replace(trimmed, r'(?s)^"(.*)"$', "$1")).otherwise(trimmed)


def clean_nested(c: Column, dtype: T.DataType) -> Column:
    """Apply :func:`clean_text` to every leaf of a struct, map or array."""
    if isinstance(dtype, T.StructType):
        return F.struct(*[clean_nested(c[f.name], f.dataType).alias(f.name) for f in dtype.fields])
    if isinstance(dtype, T.ArrayType):
        return F.transform(c, lambda x: clean_nested(x, dtype.elementType))
    if isinstance(dtype, T.MapType):
        return F.transform_values(c, lambda _, v: clean_nested(v, dtype.valueType))
    return clean_text(c)


def clean_columns(df: DataFrame) -> DataFrame:
    """Header cleanup: drop the byte-order mark, trim, lower."""
    return df.toDF(*[clean_column_name(c) for c in df.columns])


def clean_column_name(name: str) -> str:
    return name.replace("\ufeff", "").strip().lower()


def first_existing(df: DataFrame, candidates: Iterable[str]) -> Column:
    """The first candidate that is a column of ``df``, even when its value is null."""
    for name in candidates:
        if name in df.columns:
            return F.col(name)
    return F.lit(None).cast("string")


def first_value(df: DataFrame, candidates: Iterable[str], clean=clean_key) -> Column:
    """The first candidate column whose cleaned value is not null."""
    present = [clean(name) for name in candidates if name in df.columns]
    return F.coalesce(*present) if present else F.lit(None).cast("string")


def find_column(columns: Sequence[str], candidates: Sequence[str]) -> str | None:
    """Case-insensitive exact match over all candidates, else the first column containing one."""
    exact = {c.strip().lower(): c for c in reversed(columns) if c}
    for want in candidates:
        if want.strip().lower() in exact:
            return exact[want.strip().lower()]
    hits = [c for want in candidates for c in columns if c and want in c]
    return hits[0] if hits else None


def lenient_int(c: Column | str) -> Column:
    """Whole part of a number given as text; NULL when it is not a number."""
    return _col(c).try_cast("double").try_cast("int")


def lenient_double(c: Column | str) -> Column:
    return _col(c).try_cast("double")


def status_class(c: Column | str) -> Column:
    """Order status category."""
    s = _col(c)
    return (
        F.when(s.isin(*rules.NORMAL_STATUSES), "normal")
        .when(s.isin(*rules.ABNORMAL_STATUSES), "abnormal")
        .when(s.isin(*rules.EXCLUDED_STATUSES), "excluded")
        .otherwise("unclassified")
    )


def blacklist_status(reason: Column | str) -> Column:
    """``blacklisted`` or ``blacklisted:<reason>``."""
    return F.concat_ws(":", F.lit("blacklisted"), _col(reason))


def pseudonym(c: Column | str, salt: str) -> Column:
    """Salted SHA-256 of a normalised key."""
    return F.sha2(F.concat(clean_key(c), F.lit(salt)), 256)
