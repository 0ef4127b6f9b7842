"""Dimension history: validity intervals by change detection, and the version that held at a row's time."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from jobstar.functions.keys import stable_key
from jobstar.operators.asof import SALTS, asof_lookup


def dimension_history(seen: DataFrame, keys: list[str], attrs: list[str], at: str, key_col: str | None = None) -> DataFrame:
    """One row per version of each key: ``keys``, ``attrs``, ``valid_from``, ``valid_to`` (exclusive; null: still holds).

    ``seen`` lists what the attributes were at certain times, in any order and as often as one likes. A version
    begins where the attributes differ from the time before (null is a value like any other). Of several
    attributes at one time the largest count. Rows without a time do nothing; a null key is a key. ``key_col``
    adds a surrogate key of key and ``valid_from``, the same on every run.

    Rows of one key and time become one before the shuffle, so a hot key costs a row per time it was seen at, not per
    row; change and end are told in one window over one sort.
    """
    per = (seen.where(F.col(at).isNotNull()).select(*keys, F.col(at).alias("valid_from"), F.struct(*attrs).alias("__v"))
           .groupBy(*keys, "valid_from").agg(F.max("__v").alias("__v")))
    in_time = Window.partitionBy(*keys).orderBy("valid_from")
    changes = (per.withColumns({"__before": F.lag("__v").over(in_time), "__n": F.row_number().over(in_time)})
               .where((F.col("__n") == 1) | ~F.col("__v").eqNullSafe(F.col("__before"))))
    out = changes.withColumn("valid_to", F.lead("valid_from").over(in_time))
    out = out.select(*keys, *[F.col("__v")[a].alias(a) for a in attrs], "valid_from", "valid_to")
    return out.withColumn(key_col, stable_key(out, [*keys, "valid_from"])) if key_col else out


def lookup_version(fact: DataFrame, history: DataFrame, on: list[tuple[str, str]], fact_time: str, take: list[str],
                   salts: int = SALTS) -> DataFrame:
    """``fact`` with the ``take`` columns of the version that held at ``fact_time``.

    Every fact stays, once; the columns are null before a key's first version, and without a key or time. The versions of a key
    follow each other without a gap, so this is the latest to begin by then, without a join (``asof_lookup``).
    """
    return asof_lookup(fact, history, on, fact_time, "valid_from", take, salts)
