"""Readers: raw JSON (A1, A2, S2) and layered Parquet.

Paths are any Hadoop filesystem URI (``s3a://``, ``gs://``, ``hdfs://``,
local); object-store endpoints and credentials come from Spark/Hadoop
conf, never from code (A10).
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from jobstar.sources.arrays import array_elements


def layer_path(root: str, layer: str, source: str, prefix: str = "") -> str:
    """``{root}/{layer}/{prefix}{source}/{source}_jobs.parquet``, the medallion
    layout of the source pipeline."""
    return f"{root.rstrip('/')}/{layer}/{prefix}{source}/{source}_jobs.parquet"


CORRUPT_COL = "_corrupt_record"


def read_json_records(spark: SparkSession, path: str, schema: StructType,
                      multiline: bool = True, with_file: bool = False,
                      corrupt_col: str | None = None) -> DataFrame:
    """A1/A2: JSON records with an explicit schema (no inference pass).

    ``multiline=True`` reads files holding one JSON array of objects (the
    crawlers' output). Such a file is not splittable, so parallelism comes
    from many files; JSON-lines input (``multiline=False``) splits.
    With ``corrupt_col`` a malformed record keeps its raw text in that
    column (null for good rows) instead of becoming an all-null row.
    """
    if corrupt_col:
        schema = StructType(schema.fields + [StructField(corrupt_col, StringType(), True)])
    r = spark.read.schema(schema).option("multiLine", multiline).option("mode", "PERMISSIVE")
    if corrupt_col:
        r = r.option("columnNameOfCorruptRecord", corrupt_col)
    df = r.json(path)
    if with_file:
        df = df.withColumn("source_file", F.col("_metadata.file_path"))
    return df


def read_raw_records(spark: SparkSession, path: str, schema: StructType, lines: bool = False, split: bool = False) -> DataFrame:
    """A1/A2 for landing: every record on its own, nothing dropped.

    Each file holds one JSON array of records, or one record per line with
    ``lines``. Columns: those of ``schema``; ``raw``, the whole record as JSON text;
    ``_bad_fields``, names of fields whose value does not fit their type (these
    alone are null); ``source_file``; and for a file or line that is no JSON one row of nulls with the
    file's name in ``_corrupt_record``. Whole numbers that come with decimals are rounded.

    A file with an array is read by one task and must fit into its memory; with ``split`` it is cut into
    blocks for many tasks, and of a damaged file only the elements that are no JSON give a row of nulls
    (``sources.arrays``). JSON lines split.
    """
    if split and not lines:
        return _typed(array_elements(spark, path).withColumn("__r", F.try_parse_json("value")), schema)
    text = spark.read.text(path, wholetext=not lines).withColumn("source_file", F.col("_metadata.file_path"))
    if lines:
        text = text.where(F.trim("value") != "").withColumn("__r", F.try_parse_json("value"))
    else:
        # an empty array has no record; a file that is no JSON has one null row, to be counted
        text = text.withColumn("__all", F.from_json("value", "array<variant>"))
        text = text.where("__all IS NULL OR size(__all) > 0").withColumn("__r", F.explode_outer("__all"))
    return _typed(text, schema)


def _typed(text: DataFrame, schema: StructType) -> DataFrame:
    """The fields of ``schema`` out of the record ``__r`` of each row of ``text``."""
    cols, bad = [], []
    for f in schema.fields:
        if isinstance(f.dataType, (IntegerType, LongType)):
            number = F.try_variant_get("__r", f"$.{f.name}", "decimal(38,6)")
            value = F.round(number).try_cast(f.dataType)
        else:
            value = F.try_variant_get("__r", f"$.{f.name}", f.dataType.simpleString())
        cols.append(value.alias(f.name))
        given = F.try_variant_get("__r", f"$.{f.name}", "string").isNotNull()
        bad.append(F.when(given & value.isNull(), F.lit(f.name)))
    return text.select(*cols, F.to_json("__r").alias("raw"), F.array_compact(F.array(*bad)).alias("_bad_fields"),
                       "source_file", F.when(F.col("__r").isNull(), F.col("source_file")).alias(CORRUPT_COL))


def raw_quality(bronze: DataFrame) -> DataFrame:
    """Landing report: files or lines that are no JSON, and bad values per field."""
    bad = bronze.select("source_file", F.explode("_bad_fields").alias("check"))
    broken = bronze.where(F.col(CORRUPT_COL).isNotNull()).select("source_file", F.lit("malformed").alias("check"))
    return broken.unionByName(bad).groupBy("source_file", "check").agg(F.count(F.lit(1)).alias("failures"))


def read_envelopes(spark: SparkSession, path: str, schema: StructType, lines: bool = False) -> DataFrame:
    """S2/X8 input: a directory of API response pages, one envelope per file, or per line with ``lines``.
    Reading the directory is the union of the pages."""
    return spark.read.schema(schema).option("multiLine", not lines).json(path)


def read_layer(spark: SparkSession, root: str, layer: str, source: str, prefix: str = "") -> DataFrame:
    """Scan one layer's Parquet dataset."""
    return spark.read.parquet(layer_path(root, layer, source, prefix))


def read_layer_if_there(spark: SparkSession, root: str, layer: str, source: str) -> DataFrame | None:
    """The same, or None when the dataset was never written (A4)."""
    try:
        return read_layer(spark, root, layer, source)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
