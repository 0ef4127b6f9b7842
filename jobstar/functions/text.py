"""Text scalars (B6, B7, B10-B14, B22, B26, B28 predicate)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trim_lower(c) -> Column:
    """``trim(lower(c))``."""
    return F.trim(F.lower(as_col(c)))


def strip_label(c, label: str) -> Column:
    """Remove every occurrence of a fixed label (literal, not a regex)."""
    return F.replace(as_col(c), F.lit(label), F.lit(""))


def to_int(c) -> Column:
    """Text -> int; words, '' and overflow give null (ANSI-safe)."""
    return as_col(c).try_cast("int")


def to_long(c) -> Column:
    return as_col(c).try_cast("bigint")


def first_digits(c, pattern: str = r"(\d+)", group: int = 1) -> Column:
    """Regex capture; no match -> '', null -> null."""
    return F.regexp_extract(as_col(c), pattern, group)


def blank_to_null(c) -> Column:
    """'' or spaces -> null, else the trimmed text."""
    return F.nullif(F.trim(as_col(c)), F.lit(""))


def default_if_null(c, default: str = "") -> Column:
    """``coalesce(c, default)`` as string."""
    return F.coalesce(as_col(c).cast("string"), F.lit(default))


def non_blank(c) -> Column:
    """B28 predicate: not null and not ''. Null input gives false, not null."""
    c = as_col(c)
    return c.isNotNull() & (c != F.lit(""))


def nfc(c) -> Column:
    """Unicode NFC normal form. Scraped Vietnamese text may arrive decomposed
    (NFD: base letter + combining marks), which defeats ``contains`` and
    regex tests written in composed form. Spark has no built-in normaliser,
    so this is a small Arrow-batched pandas UDF; use it only where input may
    be decomposed (``silver_board_*(normalize=True)``)."""
    from jobstar.functions._nfc import nfc_udf
    return nfc_udf(as_col(c))
