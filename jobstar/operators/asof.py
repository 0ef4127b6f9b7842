"""As-of lookup: the last value at or before a row's time, per key (C4 with a dated rate table).

Spark has no as-of join. Facts and dated values are put into one table and sorted
by time per key; a running last value carries the latest dated one to each fact.
There is no join, so nothing fans out. A currency may hold most of all facts, so
a key is split: facts are dealt over ``salts`` parts by a hash of the whole row,
and the dated values, the small side, are repeated in each part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobstar.functions.parse import as_col

SALTS = 32


def asof_lookup(facts: DataFrame, dated: DataFrame, on: list[tuple[str, str]], fact_time: str, dated_time: str,
                take: list[str], salts: int = SALTS) -> DataFrame:
    """``facts`` with the ``take`` columns of the row of ``dated`` that is the latest at or before ``fact_time``.

    ``on`` names the key columns of both sides. Every fact stays, once. The
    taken columns are null where a fact has no key or time, or nothing is dated as early. Dated rows without a key or time
    do nothing; of several of one key and time that with the largest taken values counts,
    so a result never depends on partitioning. A column of ``facts`` named like a taken one is replaced.
    """
    kept = [c for c in facts.columns if c not in take]
    keys = [f"k{i}" for i in range(len(on))]
    row = F.struct(*[F.col(f"`{c}`") for c in kept])
    left = facts.select(*[F.col(f"`{a}`").alias(k) for (a, _), k in zip(on, keys)], F.col(f"`{fact_time}`").alias("at"),
                        F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in kept]), F.lit(salts)).cast("int").alias("salt"),
                        F.lit(1).alias("side"), row.alias("row"))
    value = F.struct(*[F.col(f"`{c}`") for c in take])
    some = dated.where(" AND ".join(f"`{c}` IS NOT NULL" for c in [dated_time, *(b for _, b in on)]))
    one = some.groupBy(*[F.col(f"`{b}`").alias(k) for (_, b), k in zip(on, keys)], F.col(f"`{dated_time}`").alias("at")).agg(
        F.max(value).alias("value"))
    right = one.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))).withColumn("side", F.lit(0))
    both = left.unionByName(right, allowMissingColumns=True)
    # a dated row comes before the facts of its time
    until = Window.partitionBy(*keys, "salt").orderBy("at", "side").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    known = F.col("at").isNotNull()
    for k in keys:
        known &= F.col(k).isNotNull()
    last = both.withColumn("last", F.last("value", ignorenulls=True).over(until)).where("side = 1")
    return last.select("row.*", *[F.when(known, F.col("last")[c]).alias(c) for c in take])


def to_base_currency(df: DataFrame, amount: str, currency: str, date: str, rates: DataFrame, base: str = "VND",
                     out: str = "amount_vnd", salts: int = SALTS) -> DataFrame:
    """C4 with rates as data: ``amount`` in ``currency`` turned into ``base`` by the rate in force on ``date``.

    ``rates`` has (currency, rate_date, rate), whole units of ``base``. An amount of 0 or null, a
    currency without a rate by then, and a product past 64 bits give null; the base currency needs no rate.
    """
    rated = asof_lookup(df, rates.select("currency", "rate_date", F.col("rate").alias("__rate")),
                        [(currency, "currency")], date, "rate_date", ["__rate"], salts)
    return rated.withColumn(out, _converted(amount, F.when(as_col(currency) == base, F.lit(1)).otherwise(F.col("__rate")))).drop("__rate")


def _converted(amount: str, rate: Column) -> Column:
    a = as_col(amount)
    return F.when(a != 0, F.try_multiply(a.cast("bigint"), rate.cast("bigint")))
