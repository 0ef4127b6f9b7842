"""Sinks (A3, A4, A7, A8, A9). All writes are distributed: each task
writes its own files through Spark's commit protocol; nothing is pulled
to the driver."""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobstar.sources.readers import layer_path

log = logging.getLogger(__name__)


def write_layer(df: DataFrame, root: str, layer: str, source: str, prefix: str = "",
                mode: str = "overwrite", partition_by: list[str] | None = None) -> str:
    """Write one dataset into the layered layout (replaces it by default)."""
    path = layer_path(root, layer, source, prefix)
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


MONTH = "in_month"  # no case-insensitive match with the date dimension's Month


def month_of(date: str | Column) -> Column:
    """A date's month as a number, 202501 for January 2025."""
    d = F.col(date) if isinstance(date, str) else date
    return F.year(d) * 100 + F.month(d)


def write_months(df: DataFrame, root: str, layer: str, source: str, date_col: str, prefix: str = "months_") -> str:
    """A7 in a folder per month of ``date_col`` (rows without a date in one of their own).

    Only the months that ``df`` has rows of are replaced, whole; the others stay. Rows are dealt by ranges of
    month and hash, so that a task writes to few months and a month of most rows spans tasks. A filter on the column
    ``in_month``, or a join with filtered dates (``reports.dated_distribution``), prunes the folders.
    """
    if MONTH in df.columns:
        raise ValueError(f"column {MONTH!r} names the folders")
    path = layer_path(root, layer, source, prefix)
    rows = df.withColumn(MONTH, month_of(date_col))
    spread = rows.repartitionByRange(F.col(MONTH), F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]))
    spread.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(MONTH).parquet(path)
    return path


def land_bronze(sources: dict[str, DataFrame], root: str, mode: str = "overwrite") -> dict[str, str]:
    """A3/A4: land each raw source as bronze Parquet, in place of what is there or added to it; an empty or missing
    source is skipped with a warning (``isEmpty`` reads at most one row)."""
    written = {}
    for name, df in sources.items():
        if df is None or df.isEmpty():
            log.warning("source %r is empty or missing; skipped", name)
            continue
        written[name] = write_layer(df, root, "bronze", name, mode=mode)
    return written


def write_tables(tables: dict[str, DataFrame], root: str, layer: str = "gold") -> dict[str, str]:
    """Write several named tables into one layer."""
    return {name: write_layer(df, root, layer, name) for name, df in tables.items()}


def load_warehouse(spark: SparkSession, tables: dict[str, DataFrame], database: str | None = None,
                   mode: str = "overwrite", fmt: str = "parquet",
                   path_root: str | None = None) -> list[str]:
    """Create-or-replace warehouse tables from DataFrames.

    ``saveAsTable`` writes in parallel from the executors; with
    ``path_root`` the tables are external at ``{path_root}/{name}``. For
    a JDBC warehouse use ``df.write.format("jdbc")`` with the URL and
    credentials taken from Spark conf, and ``numPartitions`` to bound
    concurrent connections.
    """
    names = []
    for name, df in tables.items():
        full = f"{database}.{name}" if database else name
        w = df.write.mode(mode).format(fmt)
        if path_root:
            w = w.option("path", f"{path_root.rstrip('/')}/{name}")
        w.saveAsTable(full)
        names.append(full)
    return names


def jdbc_credentials(spark: SparkSession, prefix: str = "spark.jobstar.jdbc") -> dict[str, str]:
    """User and password from Spark conf (``{prefix}.user``/``.password``)
    or the environment (``JOBSTAR_JDBC_USER``/``_PASSWORD``); never from code."""
    import os
    out = {}
    for key in ("user", "password"):
        v = spark.conf.get(f"{prefix}.{key}", None) or os.environ.get(f"JOBSTAR_JDBC_{key.upper()}")
        if v:
            out[key] = v
    return out


def load_jdbc(spark: SparkSession, tables: dict[str, DataFrame], url: str,
              options: dict[str, str] | None = None, max_connections: int = 8,
              mode: str = "overwrite", arrays_as_json: bool = True) -> list[str]:
    """A9 into a JDBC warehouse, written by the executors.

    ``repartition(max_connections)`` bounds concurrent connections and leaves the
    plan above its own parallelism; ``batchsize`` rows go per round trip. Array and struct columns
    become JSON text when the warehouse has no such types.
    """
    from pyspark.sql.types import ArrayType, MapType, StructType

    opts = {"batchsize": "10000", **jdbc_credentials(spark), **(options or {})}
    names = []
    for name, df in tables.items():
        if arrays_as_json:
            df = df.select(*[F.to_json(F.col(f.name)).alias(f.name)
                             if isinstance(f.dataType, (ArrayType, MapType, StructType)) else F.col(f.name)
                             for f in df.schema.fields])
        (df.repartition(max_connections).write.format("jdbc").mode(mode)
           .option("url", url).option("dbtable", name).options(**opts).save())
        names.append(name)
    return names
