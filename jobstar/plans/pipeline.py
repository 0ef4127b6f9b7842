"""End-to-end stages: ``run_bronze -> run_silver -> run_gold -> publish``.

Each stage reads what the previous one wrote, so a failed stage reruns on
its own and every stage's input is a materialised table (no lineage
spanning stages). Each stage function returns the paths it wrote.
"""

from __future__ import annotations

import logging

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession

from jobstar import schemas
from jobstar.plans.gold import gold_tables, gold_view
from jobstar.plans.silver import DEDUP_KEYS, SOURCE_A, SOURCE_B, silver_board_a, silver_board_b
from jobstar.session import materialize
from jobstar.sources import snapshots
from jobstar.sources.readers import layer_path, read_layer, read_layer_if_there, read_raw_records
from jobstar.sources.sinks import land_bronze, load_warehouse, write_layer, write_tables
from jobstar.operators.conform import with_ingest_time

log = logging.getLogger(__name__)

GOLD_NAMES = ["dim_company", "dim_jobposition", "dim_date", "dim_workform", "dim_skills",
              "fact_job", "fact_jobskill", "view"]


def _read_raw(spark: SparkSession, path: str | None, schema):
    """Raw JSON with a bronze schema; None when the path is unset or absent
    (A4: a missing source is skipped with a warning, not an error)."""
    if not path:
        return None
    try:
        return with_ingest_time(read_raw_records(spark, path, schema, split=True))
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def run_bronze(spark: SparkSession, raw_a: str | None, raw_b: str | None, root: str, append: bool = False) -> dict[str, str]:
    """Raw JSON files -> bronze Parquet (one dataset per board), in place of what is there or added to it."""
    srcs = {SOURCE_A: _read_raw(spark, raw_a, schemas.BRONZE_A),
            SOURCE_B: _read_raw(spark, raw_b, schemas.BRONZE_B)}
    return land_bronze(srcs, root, mode="append" if append else "overwrite")


def run_silver(spark: SparkSession, root: str, mode: str = "reference") -> dict[str, str]:
    """Bronze -> silver for the boards that were landed."""
    out = {}
    for source, build in ((SOURCE_A, silver_board_a), (SOURCE_B, silver_board_b)):
        bronze = read_layer_if_there(spark, root, "bronze", source)
        if bronze is None:
            log.warning("no bronze of %r; skipped", source)
            continue
        out[source] = write_layer(build(bronze, mode=mode), root, "silver", source)
    return out


def run_gold(spark: SparkSession, root: str, method: str = "derive") -> dict[str, str]:
    """Silver -> gold, from the boards that have a silver dataset. The
    unioned ``view`` is written first and the other seven tables are built
    from the written copy, so silver is scanned once instead of once per
    output table."""
    silvers = [s for s in (read_layer_if_there(spark, root, "silver", x) for x in (SOURCE_A, SOURCE_B)) if s is not None]
    if not silvers:
        log.warning("no silver dataset under %r; gold skipped", root)
        return {}
    out = {"view": write_layer(gold_view(silvers), root, "gold", "view")}
    view = read_layer(spark, root, "gold", "view")
    out.update(write_tables(gold_tables(view, method=method), root, "gold"))
    return out


def fold_silver(spark: SparkSession, root: str, mode: str = "reference", buckets: int = 64) -> dict[str, int]:
    """E2 by instalments: only bronze files that came since the last call are read, and folded into
    ``{root}/silver_snapshots`` (W1, W2); returns the number of its versions.

    Gives what ``run_silver`` gives over all bronze files, but that equal dates of board A's rows of different instalments are
    told apart by the silver columns, not the raw id, which silver no longer has.
    """
    target = f"{root.rstrip('/')}/silver_snapshots"
    for source, build in ((SOURCE_A, silver_board_a), (SOURCE_B, silver_board_b)):
        snapshots.fold_new_files(spark, layer_path(root, "bronze", source), f"{target}/_checkpoints/{source}", target, source,
                                 DEDUP_KEYS, ["job_posting_date"], buckets, lambda rows, build=build: build(rows, mode=mode))
    return {"versions": len(snapshots.versions(spark, target))}


def run_gold_snapshot(spark: SparkSession, root: str, method: str = "derive") -> int | None:
    """E3 with all eight tables published at once (A8): the new version of ``{root}/gold_snapshots``.

    Reads the silver that ``fold_silver`` keeps, or else that of ``run_silver``. Read it with ``snapshots.read_snapshot``.
    """
    base = root.rstrip("/")
    silvers = list(snapshots.read_snapshot(spark, f"{base}/silver_snapshots").values()) or [
        s for s in (read_layer_if_there(spark, root, "silver", x) for x in (SOURCE_A, SOURCE_B)) if s is not None]
    if not silvers:
        log.warning("no silver dataset under %r; gold skipped", root)
        return None
    view = materialize(gold_view(silvers), "gold-view")
    return snapshots.publish(spark, f"{base}/gold_snapshots", {"view": view, **gold_tables(view, method=method)})


def publish(spark: SparkSession, root: str, database: str | None = None,
            path_root: str | None = None) -> list[str]:
    """Gold datasets -> warehouse tables, written by the executors."""
    tables = {n: read_layer(spark, root, "gold", n) for n in GOLD_NAMES}
    return load_warehouse(spark, tables, database=database, path_root=path_root)


def run_all(spark: SparkSession, raw_a: str | None, raw_b: str | None, root: str, mode: str = "reference",
            database: str | None = None) -> dict[str, object]:
    return {"bronze": run_bronze(spark, raw_a, raw_b, root),
            "silver": run_silver(spark, root, mode),
            "gold": run_gold(spark, root),
            "warehouse": publish(spark, root, database) if database else []}
