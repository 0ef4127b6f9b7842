"""Dashboard queries over the star schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _measure(count_distinct: str | None, out: str):
    m = F.count_distinct(F.col(count_distinct)) if count_distinct else F.count(F.lit(1))
    return m.alias(out)


def distribution(df: DataFrame, by: list[str], count_distinct: str | None = None,
                 out: str = "n") -> DataFrame:
    """Row (or distinct id) count per value of ``by``."""
    return df.groupBy(*by).agg(_measure(count_distinct, out))


def top_n(df: DataFrame, by: list[str], n: int, count_distinct: str | None = None,
          out: str = "n") -> DataFrame:
    """The ``n`` largest groups, ties broken by the group value so
    the report is deterministic. ``orderBy + limit`` plans as
    ``TakeOrderedAndProject`` (per-task top-n, then a merge of n rows per
    task), and ``count_distinct`` is planned as two aggregations, so
    neither a hot group nor the sort concentrates rows in one task."""
    g = distribution(df, by, count_distinct, out)
    return g.orderBy(F.col(out).desc(), *[F.col(c).asc_nulls_last() for c in by]).limit(n)


def dated_distribution(fact: DataFrame, dates: DataFrame, where: str, by: list[str], measures: dict[str, Column] | None = None,
                       date_col: str = "DateID", month_col: str = "in_month") -> DataFrame:
    """G10 over the days of the date dimension that ``where`` keeps, for a fact stored by month (``sinks.write_months``).

    ``dates`` is a date dimension (``star.build_date_dimension``), whose columns ``by`` may name as well as the fact's. Joined on month and
    day, so Spark's dynamic partition pruning scans only the months of the days that are kept. ``measures`` are
    aggregates by name (default: ``n``, the rows).
    """
    own = [c for c in dates.columns if c not in fact.columns or c == "DateID"]
    days = dates.where(where).select(*[F.col(c).alias("__day" if c == "DateID" else c) for c in own],
                                     (F.col("Year") * 100 + F.col("Month")).alias("__month"))
    joined = fact.join(days, (fact[month_col] == F.col("__month")) & (F.to_date(fact[date_col]) == F.col("__day")))
    return joined.groupBy(*by).agg(*[c.alias(n) for n, c in (measures or {"n": F.count(F.lit(1))}).items()])
