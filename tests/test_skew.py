"""Hot keys: one key holds a third of all rows. Results are checked against a
pandas brute force; AQE skew-join thresholds are lowered so the skewed
partition is actually split."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from jobstar.operators.dedup import latest_per_key
from jobstar.operators.joins import lookup
from jobstar.operators.reports import top_n
from jobstar.operators.star import build_dimension
from tests.helpers import plan_text

N = 30_000


@pytest.fixture(scope="module")
def hot(spark):
    rows = [("hot" if i % 3 == 0 else f"k{i % 997}", i, (i * 7919) % 1000, f"d{i % 13}") for i in range(N)]
    return spark.createDataFrame(rows, "key string, id int, score int, dim string").repartition(16)


@pytest.fixture()
def skew_conf(spark):
    conf = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
            "spark.sql.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def test_latest_per_key_hot(hot):
    got = {(r.key, r.id) for r in latest_per_key(hot, ["key"], ["score"]).collect()}
    pdf = hot.toPandas().sort_values(["key", "score", "id"], ascending=[True, False, True])
    want = {(r.key, r.id) for r in pdf.groupby("key").head(1).itertuples()}
    assert got == want


def test_dimension_and_top_n_hot(hot):
    pdf = hot.toPandas()
    dim = build_dimension(hot, {"key": "key", "dim": "dim"}, "kid")
    assert dim.count() == len(pdf[["key", "dim"]].drop_duplicates())
    top = [tuple(r) for r in top_n(hot, ["key"], 3, count_distinct="dim").collect()]
    want = (pdf.groupby("key")["dim"].nunique().reset_index()
               .sort_values(["dim", "key"], ascending=[False, True]).head(3))
    assert top == [tuple(x) for x in want.itertuples(index=False)]


def test_lookup_hot_key_shuffle_join(spark, hot, skew_conf):
    dim = build_dimension(hot, {"key": "key"}, "kid")
    out = lookup(hot, dim.hint("merge"), [("key", "key")], ["kid"])
    assert "BroadcastHashJoin" not in plan_text(out)
    assert out.count() == N and out.filter(F.col("kid").isNull()).count() == 0
    per_key = {r.key: r.n for r in out.groupBy("key").agg(F.count("*").alias("n")).collect()}
    assert per_key["hot"] == N // 3
