"""Several tables published as one (A8, A9), and tables kept in parts that are replaced one by one.

Data is only ever written to new folders. A *manifest*, one small JSON file per version under
``{root}/_manifests``, says which folders make up each table. It is written under a private name and renamed to
its version's name as the last step, so a reader sees the tables of one version or of the next, never
a mix, and a run that dies before has changed nothing. The rename refuses an
existing name: of two writers that started from one version the second fails and can start again.

The rename must be atomic, as it is on HDFS and local disks; on an object store
without atomic renames keep ``root`` on a committing file system.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobstar.operators.dedup import latest_per_key


class Conflict(RuntimeError):
    """Another writer published the version that this one was to be."""


def _hadoop(spark: SparkSession, path: str):
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, conf, p, p.getFileSystem(conf)


def versions(spark: SparkSession, root: str) -> list[int]:
    """Published versions, the oldest first."""
    _, _, folder, fs = _hadoop(spark, f"{root}/_manifests")
    if not fs.exists(folder):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith("_"))


def manifest(spark: SparkSession, root: str, version: int | None = None) -> dict:
    """The manifest of a version, of the latest by default: {"version", "tables": {name: {part: folder}}, "done": {source: last batch}}."""
    known = versions(spark, root)
    if version is None and not known:
        return {"version": 0, "tables": {}, "done": {}}
    version = known[-1] if version is None else version
    jvm, _, path, fs = _hadoop(spark, f"{root}/_manifests/{version:012d}.json")
    stream = fs.open(path)
    try:
        return json.loads(jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def _commit(spark: SparkSession, root: str, new: dict) -> int:
    """Make ``new`` the next version, or raise ``Conflict``."""
    jvm, conf, folder, fs = _hadoop(spark, f"{root}/_manifests")
    fs.mkdirs(folder)
    private = jvm.org.apache.hadoop.fs.Path(folder, f"_{uuid.uuid4().hex}")
    out = fs.create(private, False)
    out.write(bytearray(json.dumps(new, sort_keys=True).encode()))
    out.close()
    final = jvm.org.apache.hadoop.fs.Path(folder, f"{new['version']:012d}.json")
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(folder.toUri(), conf)
    try:
        context.rename(private, final, spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0))
    except Exception as e:
        if fs.exists(final):
            fs.delete(private, False)
            raise Conflict(f"version {new['version']} of {root} is already there") from e
        raise
    return new["version"]


def publish(spark: SparkSession, root: str, tables: dict[str, DataFrame]) -> int:
    """Write all ``tables`` and make them visible at once; tables of the last version that are not among them stay as they are.

    Returns the new version.
    """
    old = manifest(spark, root)
    new = {"version": old["version"] + 1, "tables": dict(old["tables"]), "done": dict(old["done"])}
    for name, df in tables.items():
        folder = f"{root}/{name}/{new['version']:012d}-{uuid.uuid4().hex[:8]}"
        df.write.parquet(folder)
        new["tables"][name] = {"": folder}
    return _commit(spark, root, new)


def read_snapshot(spark: SparkSession, root: str, names: list[str] | None = None, version: int | None = None) -> dict[str, DataFrame]:
    """Tables of one version (the latest by default), all of the same one."""
    tables = manifest(spark, root, version)["tables"]
    return {n: spark.read.parquet(*tables[n].values()) for n in (names or tables)}


def expire(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Remove the manifests before the last ``keep`` and the folders that only these name; returns the folders."""
    known = versions(spark, root)
    folders = {v: {f for parts in manifest(spark, root, v)["tables"].values() for f in parts.values()} for v in known}
    stay = set().union(*(folders[v] for v in known[-keep:]))
    gone = sorted(set().union(*folders.values()) - stay)
    for v in known[:-keep]:
        _, _, path, fs = _hadoop(spark, f"{root}/_manifests/{v:012d}.json")
        fs.delete(path, False)
    for folder in gone:
        _, _, path, fs = _hadoop(spark, folder)
        fs.delete(path, True)
    return gone


BUCKET = "__bucket"


def fold_latest(spark: SparkSession, root: str, name: str, new: DataFrame, keys: list[str], order_by: list[str],
                buckets: int = 64, source: str = "batch", batch: int | None = None) -> int | None:
    """Fold new rows into table ``name``, which keeps the latest row per key (W1, W2), bucket by bucket.

    The table is kept in ``buckets`` parts by a hash of the keys. Only parts that get a new
    row are read and written again; the others keep their folders. Latest by
    ``order_by``, ties by all other columns, so instalments in any order give what one pass over all
    rows gives. With ``batch`` a number that ``source`` has already folded in does nothing. Returns the new version, or
    None where nothing was done. Null keys are keys like any other. The number of buckets is fixed by the first fold.
    """
    old = manifest(spark, root)
    if batch is not None and old["done"].get(f"{name}/{source}", -1) >= batch:
        return None
    parts = old["tables"].get(name, {})
    buckets = int(next(iter(parts)).split("/")[1]) if parts else buckets
    number = F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in keys]), F.lit(buckets)).cast("int")
    latest = latest_per_key(new, keys, order_by).withColumn(BUCKET, number)
    folder = f"{root}/{name}/{old['version'] + 1:012d}-{uuid.uuid4().hex[:8]}"
    # the instalment's latest rows are stored once: what they touch decides what is read
    latest.write.parquet(f"{folder}/_new")
    latest = spark.read.parquet(f"{folder}/_new")
    touched = [r[BUCKET] for r in latest.select(BUCKET).distinct().collect()]  # at most one row per bucket
    label = {b: f"{b}/{buckets}" for b in touched}
    before = [parts[label[b]] for b in touched if label[b] in parts]
    rows = latest
    if before:
        rows = rows.unionByName(spark.read.parquet(*before).withColumn(BUCKET, number))
        rows = latest_per_key(rows, keys, order_by)
    if touched:
        # by range of part and hash of the keys, so that a task writes to few parts and a large part spans tasks
        rows.repartitionByRange(F.col(BUCKET), F.xxhash64(*[F.col(f"`{k}`") for k in keys])).write.partitionBy(BUCKET).parquet(f"{folder}/rows")
    done = old["done"] | ({f"{name}/{source}": batch} if batch is not None else {})
    fresh = {label[b]: f"{folder}/rows/{BUCKET}={b}" for b in touched}
    version = _commit(spark, root, {"version": old["version"] + 1, "done": done,
                                    "tables": old["tables"] | ({name: parts | fresh} if parts or fresh else {})})
    _, _, path, fs = _hadoop(spark, f"{folder}/_new")
    fs.delete(path, True)
    return version


def fold_new_files(spark: SparkSession, src: str, checkpoint: str, root: str, name: str, keys: list[str], order_by: list[str],
                   buckets: int = 64, prepare: Callable[[DataFrame], DataFrame] | None = None) -> None:
    """Fold the Parquet files of ``src`` that came since the last call into table ``name``, then stop.

    The file source's checkpoint knows the files; a run that died between its commit and the checkpoint's
    comes again with the same batch number and does nothing twice.
    """
    try:
        schema = spark.read.parquet(src).schema
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return  # nothing has come yet (A4)
        raise

    def fold(rows: DataFrame, batch: int) -> None:
        fold_latest(rows.sparkSession, root, name, prepare(rows) if prepare else rows, keys, order_by, buckets, src, batch)

    (spark.readStream.schema(schema).parquet(src).writeStream.foreachBatch(fold)
     .option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination())
