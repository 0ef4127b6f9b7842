"""Lookup joins.

No broadcast hint is given. A stored dimension's file size decides at
planning time, and where the dimension comes out of a shuffle AQE measures that shuffle's
output at run time; both switch to a broadcast join only below Spark's
thresholds, and AQE splits skewed keys of the shuffle join otherwise.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup(fact: DataFrame, dim: DataFrame, on: list[tuple[str, str]], take: list[str],
           how: str = "left", null_safe: bool = True) -> DataFrame:
    """Attach ``take`` columns of ``dim`` to ``fact`` by the FULL
    natural key ``on = [(fact_col, dim_col), ...]``.

    Joining on the whole key of a dimension that is unique on it means the
    fact can never fan out (the source joined on part of the key). With
    ``null_safe`` a null key part matches a null dimension key part.
    """
    d = dim.select(*[F.col(dc).alias(f"__d{i}") for i, (_, dc) in enumerate(on)],
                   *[F.col(t) for t in take])
    conds = [(fact[fc].eqNullSafe(d[f"__d{i}"]) if null_safe else fact[fc] == d[f"__d{i}"])
             for i, (fc, _) in enumerate(on)]
    out = fact.join(d, reduce(lambda a, b: a & b, conds), how)
    return out.drop(*[f"__d{i}" for i in range(len(on))])
