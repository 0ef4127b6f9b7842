"""Conform sources to one schema and combine them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from jobstar.functions.keys import row_key
from jobstar.functions.text import non_blank


def to_schema(df: DataFrame, schema: StructType, allow_missing: bool = False) -> DataFrame:
    """Select exactly ``schema``'s columns in its order and types.

    Columns whose type differs are converted with ``try_cast`` (bad value ->
    null). A missing column raises unless ``allow_missing``.
    """
    have = {f.name: f.dataType for f in df.schema.fields}
    cols = []
    for f in schema.fields:
        if f.name not in have:
            if not allow_missing:
                raise ValueError(f"column {f.name!r} missing; have {sorted(have)}")
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
        elif have[f.name] == f.dataType:
            cols.append(F.col(f.name))
        else:
            cols.append(F.col(f.name).try_cast(f.dataType).alias(f.name))
    return df.select(*cols)


def rename(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """B1: rename columns (missing names are ignored, as in Spark)."""
    return df.withColumnsRenamed(mapping)


def union_sources(dfs: list[DataFrame], allow_missing: bool = False) -> DataFrame:
    """Bag union by column name (no dedup across sources). Spark widens
    int/bigint -> bigint and bigint/double -> double. A column that a source lacks
    raises; with ``allow_missing`` it is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), dfs)


def required_filter(df: DataFrame, cols: list[str]) -> DataFrame:
    """Keep rows where every column in ``cols`` is not null and not ''."""
    cond = reduce(lambda a, b: a & b, [non_blank(c) for c in cols])
    return df.filter(cond)


def with_source(df: DataFrame, name: str, col: str = "source") -> DataFrame:
    """Constant source tag."""
    return df.withColumn(col, F.lit(name))


def with_ingest_time(df: DataFrame, col: str = "ingest_time") -> DataFrame:
    """Landing timestamp (lineage column on bronze)."""
    return df.withColumn(col, F.current_timestamp())


def with_row_key(df: DataFrame, cols: list[str], out: str = "id") -> DataFrame:
    """A landing row id that is the same on every rerun (md5 of e.g.
    the posting link), instead of a per-run sequential counter, which would
    need one task to number all rows."""
    return df.withColumn(out, row_key(df, cols))
