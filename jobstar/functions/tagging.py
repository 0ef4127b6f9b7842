"""Keyword tagging (C8, U1, U3) as one native expression.

The source job ran a row-at-a-time Python UDF over a broadcast list. Here
the vocabulary becomes literals inside a single projection: each keyword
is a JVM ``contains`` and the result keeps vocabulary order.

The array is built as ``concat(if(hit, [k], []), ...)``, not
``array_compact(array(...))``: ``array_compact`` is a lambda filter that
drops the projection out of whole-stage codegen, and outside codegen
``lower(text)`` is recomputed once per keyword (5x slower on long texts).
Inside codegen, subexpression elimination computes it once per row.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobstar.functions.text import as_col

# ---- fixed values: the source job's skill vocabulary, in its order ------
SKILL_KEYWORDS = [
    "python", "java", "scala", "sql", "javascript", "html", "css",
    "react", "node", "angular", "spring", "docker", "kubernetes",
    "aws", "azure", "gcp", "git", "linux", "rest", "graphql",
    "c#", "c++", "flutter", "android", "ios",
    "spark", "hadoop", "kafka", "hive", "hbase", "airflow", "odoo", "nosql",
    "elasticsearch", "zookeeper", "cassandra", "mongodb", "redis",
    "flink", "beam", "storm",
    "tensorflow", "pytorch", "mlflow",
    "jupyter", "zeppelin",
    "etl", "data pipeline", "data warehouse", "data lake",
    "bigquery", "redshift", "snowflake",
    "bash", "shell", "powershell",
    "ruby", "perl", "matlab",
    "jenkins", "circleci", "travisci",
    "prometheus", "grafana",
    "api", "microservices", "serverless",
]
# -------------------------------------------------------------------------


def keyword_tags(text, vocab: list[str] | None = None, word_boundary: bool = False,
                 lowered: bool = False) -> Column:
    """Vocabulary words found in ``text`` -> array<string>.

    Substring match by default, as in the source ("java" is found in
    "javascript"); null or '' text -> []. ``word_boundary=True`` only
    accepts matches not glued to letters or digits. ``lowered=True`` when
    ``text`` is already lower-cased (see ``with_keyword_tags``).
    """
    vocab = [k.lower() for k in (vocab or SKILL_KEYWORDS)]
    low = as_col(text) if lowered else F.lower(as_col(text))
    if word_boundary:
        tests = [low.rlike(r"(?<![\p{L}\p{N}])" + re.escape(k) + r"(?![\p{L}\p{N}])") for k in vocab]
    else:
        tests = [low.contains(k) for k in vocab]
    none = F.array().cast("array<string>")
    return F.concat(*[F.when(t, F.array(F.lit(k))).otherwise(none) for t, k in zip(tests, vocab)])


def with_keyword_tags(df: DataFrame, text_col: str, out: str, vocab: list[str] | None = None,
                      word_boundary: bool = False) -> DataFrame:
    """``df`` plus ``out`` = ``keyword_tags(text_col)``, with ``lower(text)``
    computed in its own projection.

    Catalyst does not merge a projection whose expensive alias is used many
    times into the next one, so the lower-cased text is computed once per
    row even when a large stage falls back from whole-stage codegen to
    interpreted evaluation (where ``keyword_tags`` alone would lower the
    text once per keyword).
    """
    tmp = f"__{out}_lower"
    x = df.withColumn(tmp, F.lower(F.col(text_col)))
    x = x.withColumn(out, keyword_tags(F.col(tmp), vocab, word_boundary, lowered=True))
    return x.drop(tmp)
