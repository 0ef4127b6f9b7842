"""Exact deduplication by stateful streaming (operator 1, DataFrame functions only).

A Structured Streaming aggregation keeps one state row per text digest in
RocksDB (on disk, no watermark, so no expiry). The state holds the digest,
the stable identifier of the row to keep, the locator of its content (file and row) and
the number of rows seen; results are read from it. Where a digest was hit more than
once, the full bytes of its rows are compared, with the content that the locator names
where that came with an earlier arrival: texts that share a digest and differ are told apart.
"""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobstar.llm.bits import bit_table, bits_for, with_may
from jobstar.session import materialize, scratch_path

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_STORE = "spark.sql.streaming.stateStore"
#: state in RocksDB; changes go to the checkpoint as a log, an executor closes each store after its
#: commit, and all stores of an executor share bounded buffers
_STATE_CONF = {
    f"{_STORE}.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    f"{_STORE}.rocksdb.changelogCheckpointing.enabled": "true",
    f"{_STORE}.unloadOnCommit": "true",
    f"{_STORE}.rocksdb.boundedMemoryUsage": "true",
    f"{_STORE}.rocksdb.maxMemoryUsageMB": "256",
    f"{_STORE}.rocksdb.writeBufferSizeMB": "8",
    f"{_STORE}.rocksdb.maxWriteBufferNumber": "2",
}
RESULT = ("keep_id", "group_size", "kept", "text_sha256")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; null counts as empty. ``lower`` serves texts
    that are ASCII throughout, where the two agree and it is faster."""
    t = F.coalesce(text.cast("string"), F.lit(""))
    return (F.when(F.octet_length(t) == F.length(t), F.lower(t))
             .otherwise(F.translate(t, _UPPER, _UPPER.lower())))


@contextmanager
def _settings(spark: SparkSession, conf: dict[str, str]):
    old = {key: spark.conf.get(key, None) for key in conf}
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in old.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def _plain_scan(docs: DataFrame) -> bool:
    """Whether each row of ``docs`` is a row of a Parquet file of its own: a scan, filtered and projected at most."""
    node = docs._jdf.queryExecution().analyzed()
    while node.getClass().getSimpleName() in ("Project", "Filter", "SubqueryAlias"):
        node = node.child()
    return node.getClass().getSimpleName() == "LogicalRelation" and "parquet" in node.relation().toString().lower()


def _located(docs: DataFrame) -> DataFrame:
    """``docs`` with ``_at``, the file and row of each row."""
    data = docs.metadataColumn("_metadata")
    return docs.select("*", F.struct(data["file_path"].alias("file"), data["row_index"].alias("row")).alias("_at"))


def _stored(spark: SparkSession, df: DataFrame, path: str) -> DataFrame:
    """``df`` written to ``path``, unless that was done before."""
    jvm = spark.sparkContext._jvm
    done = jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    if not done.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(done):
        df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def digest_state(facts: DataFrame, store: str, arrival: str, files_per_batch: int = 10_000) -> DataFrame:
    """Fold ``facts`` (_digest, _id, _at) into the keyed state that ``store`` keeps and return
    it: one row per digest with ``_best`` (largest identifier, its locator) and ``_n``.

    Facts are stored under the name of their arrival, and the stream's checkpoint knows which files it has read, so an
    arrival that comes again changes nothing. Every micro-batch writes its changed keys under its own batch number, so
    a repeated batch replaces itself. Maximum and count only ever grow, hence
    the largest value over the batches is the last one.
    """
    spark = facts.sparkSession
    schema = _stored(spark, facts, f"{store}/facts/{arrival}").schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(f"{store}/facts/*")
    state = stream.groupBy("_digest").agg(F.max(F.struct("_id", "_at")).alias("_best"), F.count(F.lit(1)).alias("_n"))
    with _settings(spark, _STATE_CONF):
        (state.writeStream.outputMode("update").trigger(availableNow=True)
         .option("checkpointLocation", f"{store}/stream")
         .foreachBatch(lambda batch, i: batch.write.mode("overwrite").parquet(f"{store}/state/batch={i}"))
         .start().awaitTermination())
    ident = schema["_id"].dataType.simpleString()
    kept = spark.read.schema(f"_digest string, _best struct<_id:{ident},_at:struct<file:string,row:bigint>>, _n bigint, "
                             "batch bigint").parquet(f"{store}/state")
    return kept.groupBy("_digest").agg(F.max("_best").alias("_best"), F.max("_n").alias("_n"))


def _earlier_contents(state: DataFrame, seen: DataFrame) -> DataFrame | None:
    """(_digest, _norm) that the locators of ``state`` name, of digests whose row to keep is not among ``seen``."""
    old = state.select("_digest", F.col("_best._at").alias("_at")).join(seen, "_digest", "left_anti")
    files = [r[0] for r in old.select("_at.file").distinct().collect()]  # of earlier arrivals, which were listed to be read
    if not files:
        return None
    return _located(state.sparkSession.read.parquet(*files)).select("_at", "_norm").join(old, "_at").select("_digest", "_norm")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", store: str | None = None,
                arrival: str | None = None, digest_bits: int = 256) -> DataFrame:
    """Every row of ``docs`` with ``keep_id``, ``group_size``, ``kept`` and ``text_sha256``.

    Texts are equal when identical after lower-casing A-Z; of equal texts the
    row with the largest identifier is kept. A null text counts as empty, a
    null identifier as the smallest. Rows that repeat both text and identifier
    count each in ``group_size`` and one of them is kept. An empty table gives
    an empty result. Columns of ``docs`` that carry a result's name are replaced, all others kept, whatever their names.

    With ``store``, a shared folder, the state outlives the call: the rows of this ``arrival`` meet those of
    earlier ones, and ``keep_id`` and ``group_size`` are over all rows so far. Contents are stored there too. An arrival that is
    named and comes again counts once. Without it the state lasts for the call. ``digest_bits`` shortens the
    state's digest; rows of texts that share one are grouped by the text itself, within their arrival.
    """
    docs, spark = docs.drop(*RESULT), docs.sparkSession
    names, arrival = docs.columns, arrival or uuid.uuid4().hex
    columns = [f"c{i}" for i in range(len(names))]  # no helper column has such a name
    id_col, text_col = columns[names.index(id_col)], columns[names.index(text_col)]
    docs = docs.toDF(*columns)
    if store:
        docs = _stored(spark, docs.withColumn("_norm", ascii_lower(F.col(text_col))), f"{store}/contents/{arrival}").drop("_norm")
    elif not _plain_scan(docs):
        docs = materialize(docs, "dedup-docs")
    norm = ascii_lower(F.col(text_col))
    sha = F.sha2(norm, 256)
    whole = digest_bits == 256
    rows = _located(docs).withColumn("_digest", sha if whole else F.substring(sha, 1, digest_bits // 4))
    result = [*columns, F.when(F.col("_n").isNull(), F.col(id_col)).otherwise(F.col("_best._id")).alias("keep_id"),
              F.coalesce("_n", F.lit(1)).cast("long").alias("group_size"),
              F.coalesce(F.col("_at") == F.col("_best._at"), F.lit(True)).alias("kept"),
              (F.col("_digest") if whole else sha).alias("text_sha256")]
    facts = rows.select("_digest", F.col(id_col).alias("_id"), "_at")
    if facts.isEmpty():
        return _nothing(docs, id_col, sha, names)
    state = digest_state(facts, store or scratch_path(spark, "dedup-store"), arrival)
    state = materialize(state.where("_n > 1"), "dedup-groups")  # a digest of one row needs no more

    # a table of bits, of bounded size whatever the corpus, tells which rows can be hits: others never move
    size = bits_for(state.count())
    rows = with_may(rows, bit_table(state, "_digest", size), "_digest", size)
    # the full bytes of hits, equal ones joined into one within each task before they move
    hits = rows.where("_may").withColumn("_norm", norm)
    if store:
        texts = materialize(hits.groupBy("_digest", "_norm").agg(F.max(F.struct(F.col(id_col).alias("_id"), "_at")).alias("_last")), "dedup-texts")
        earlier = _earlier_contents(state.join(texts.select("_digest").distinct(), "_digest", "left_semi"),
                                    texts.join(state.select("_digest", "_best"), "_digest").where("_last._at = _best._at").select("_digest"))
        texts = texts.select("_digest", "_norm")
        if earlier is not None:
            texts = texts.unionByName(earlier).distinct()
    else:
        texts = hits.select("_digest", "_norm").distinct()
    unlike = texts.groupBy("_digest").agg(F.count(F.lit(1)).alias("_texts")).where("_texts > 1").select("_digest")
    unlike = materialize(unlike, "dedup-unlike")

    def looked_up(some: DataFrame) -> DataFrame:
        alone = some.where("NOT _may").withColumns({f.name: F.lit(None).cast(f.dataType) for f in state.schema if f.name != "_digest"})
        return alone.select(*result).unionByName(some.where("_may").join(state, "_digest", "left").select(*result))

    if unlike.isEmpty():
        return looked_up(rows).toDF(*names, *RESULT)
    apart = rows.join(unlike, "_digest", "left_semi").withColumn("_norm", norm)
    groups = apart.groupBy("_digest", "_norm").agg(
        F.max(F.struct(F.col(id_col).alias("_id"), "_at")).alias("_best"), F.count(F.lit(1)).alias("_n"))
    out = looked_up(rows.join(unlike, "_digest", "left_anti"))
    return out.unionByName(apart.join(groups, ["_digest", "_norm"]).select(*result)).toDF(*names, *RESULT)


def _nothing(docs: DataFrame, id_col: str, sha: Column, names: list[str]) -> DataFrame:
    """The result of an empty table."""
    return docs.select("*", F.col(id_col).alias("keep_id"), F.lit(0).cast("long").alias("group_size"),
                       F.lit(True).alias("kept"), sha.alias("text_sha256")).toDF(*names, *RESULT)
