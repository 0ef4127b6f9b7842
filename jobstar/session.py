"""Session creation and the shared scratch location used to cut lineage."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import SparkSession

# Defaults sized for local testing; on a cluster the submitter's conf wins
# because ``getOrCreate`` keeps an existing session's settings.
_DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_spark(app: str = "jobstar", master: str | None = None,
              shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(_DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session without one (tests) gets a private folder; on a
    cluster a missing setting is an error, since each executor would write to a disk of its own.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="jobstar-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def materialize(df, name: str = "materialized"):
    """Cut the lineage of ``df``: write it once as Parquet under the shared
    checkpoint folder and read it back, so several consumers read the
    stored copy (pruning to the columns each needs) instead of recomputing
    it, and a lost executor does not force a recomputation from the sources.

    Preferred over ``DataFrame.checkpoint(eager=True)``, which on an
    unpersisted plan runs it twice (one job to count, one to write) and
    stores rows, not columns.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


_scratch: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder, removed when the Python process ends."""
    if not _scratch:
        atexit.register(clear_scratch)
    _scratch.append(f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex[:12]}")
    return _scratch[-1]


def _remove(spark: SparkSession, paths: list[str]) -> None:
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(conf).delete(path, True)
        _scratch.remove(p)


def discard(df) -> None:
    """Remove the stored copy behind a ``materialize``d frame that nothing reads any more."""
    names = {f.rsplit("/", 2)[-2] for f in df.inputFiles()}
    _remove(df.sparkSession, [p for p in _scratch if p.rsplit("/", 1)[-1] in names])


def clear_scratch() -> None:
    """Remove all scratch paths of this process; results that still read them are lost."""
    spark = SparkSession.getActiveSession()
    if spark is not None and spark.sparkContext._jsc is not None:
        _remove(spark, list(_scratch))


def object_store_conf(endpoint: str, path_style: bool = True, ssl: bool | None = None) -> dict[str, str]:
    """A10: Hadoop S3A settings for an S3-compatible object store, to pass as
    ``get_spark(extra=...)`` or ``--conf``. Credentials are not taken here:
    the provider chain reads them from the environment or instance profile."""
    conf = {
        "spark.hadoop.fs.s3a.endpoint": endpoint,
        "spark.hadoop.fs.s3a.path.style.access": str(path_style).lower(),
        "spark.hadoop.fs.s3a.impl": "org.apache.hadoop.fs.s3a.S3AFileSystem",
        "spark.hadoop.fs.s3a.aws.credentials.provider":
            "com.amazonaws.auth.EnvironmentVariableCredentialsProvider",
    }
    if ssl is None:
        ssl = endpoint.startswith("https://")
    conf["spark.hadoop.fs.s3a.connection.ssl.enabled"] = str(ssl).lower()
    return conf


def cluster_conf(input_bytes: int, total_cores: int, shuffle_fraction: float = 0.3,
                 target_partition_bytes: int = 200 * 1024 * 1024) -> dict[str, str]:
    """Starting settings for a large run, from the input size and the cores.

    Scan splits of 256 MB; the initial shuffle partition count is the
    expected shuffle volume (``shuffle_fraction`` of the input, e.g. the
    silver/gold columns that cross a shuffle) over ~200 MB, at least two
    waves of tasks; AQE then coalesces small partitions and splits skewed
    ones at runtime.
    """
    shuffle_parts = max(2 * total_cores, int(input_bytes * shuffle_fraction // target_partition_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": "256m",
        "spark.sql.shuffle.partitions": str(shuffle_parts),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    }
