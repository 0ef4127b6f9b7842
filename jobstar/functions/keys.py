"""Deterministic surrogate keys (replaces B23 ``hash`` and B27
``monotonically_increasing_id``).

A key is taken from the md5 of the natural key's text, so it is the same on
every rerun, for any partitioning, and in any engine with md5. Dimensions get
its first 60 bits as a bigint; rows of a fact, which can be many more, get all 128
bits as hex text. No global sort or single-task numbering is needed.

The text of a key is injective: every part and every array item is written
with its length before it, null as a mark that no length can be.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

NULL_MARK = "N"


def _measured(c: Column) -> Column:
    txt = c.cast("string")
    return F.coalesce(F.concat(F.length(txt).cast("string"), F.lit(":"), txt), F.lit(NULL_MARK))


def key_text(df: DataFrame, cols) -> Column:
    """Natural key -> one string, different for different keys: nulls,
    empty texts, empty arrays and arrays of either all differ. ``cols`` are names or
    columns; their types come from ``df``."""
    parts = []
    for c, field in zip(cols, df.select(*cols).schema.fields):
        col = F.col(c) if isinstance(c, str) else c
        if isinstance(field.dataType, ArrayType):
            items = F.array_join(F.transform(col, _measured), "")
            parts.append(F.coalesce(F.concat(F.size(col).cast("string"), F.lit("["), items, F.lit("]")),
                                    F.lit(NULL_MARK)))
        else:
            parts.append(_measured(col))
    return F.concat(*parts)


def stable_key(df: DataFrame, cols) -> Column:
    """60-bit non-negative bigint from md5 of the natural key text, for dimensions."""
    return F.conv(F.substring(F.md5(key_text(df, cols)), 1, 15), 16, 10).cast("bigint")


def row_key(df: DataFrame, cols) -> Column:
    """All 128 bits of that md5 as hex text, for rows of a fact."""
    return F.md5(key_text(df, cols))
