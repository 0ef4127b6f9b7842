"""Keep the latest record per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType


def latest_per_key(df: DataFrame, keys: list[str], order_by: list[str],
                   descending: bool = True, tie_break: list[Column] | None = None) -> DataFrame:
    """One row per ``keys``: the latest by ``order_by``.

    ``descending`` sorts newest first with nulls last (the source's
    ``desc(date)``, W3). Ties are broken by ``tie_break``, or by every
    remaining column ascending, so the kept row never depends on
    partitioning (the source left ties arbitrary).

    Plan: ``row_number() = 1`` lets Catalyst insert a partial
    ``WindowGroupLimit`` before the shuffle, so each map task forwards at
    most one row per key; a hot key costs one row per map task, not all
    of its rows.
    """
    order = [F.col(c).desc_nulls_last() if descending else F.col(c).asc_nulls_last()
             for c in order_by]
    if tie_break is None:
        used = set(keys) | set(order_by)
        tie_break = [F.col(f.name).asc_nulls_last() for f in df.schema.fields
                     if f.name not in used and not isinstance(f.dataType, MapType)]
    w = Window.partitionBy(*keys).orderBy(*order, *tie_break)
    rn = "__rn"
    return df.withColumn(rn, F.row_number().over(w)).filter(F.col(rn) == 1).drop(rn)
