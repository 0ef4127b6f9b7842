"""Dimension history, monthly layers, key checks in one aggregation, sketches."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from jobstar.operators.checks import fk_violations, key_checks, pk_violations
from jobstar.operators.history import dimension_history, lookup_version
from jobstar.operators.sketches import distinct_from_sketches, distinct_sketches
from jobstar.sources.readers import read_layer
from jobstar.sources.sinks import write_months

DAY = dt.date(2025, 1, 1)


def _versions(rows):
    """Versions of each key by going through its days."""
    out, by_key = [], {}
    for key, day, a, b in rows:
        if day is not None:
            worth = lambda v: tuple((x is not None, x or 0) for x in v)
            days = by_key.setdefault(key, {})
            days[day] = max(days.get(day, (a, b)), (a, b), key=worth)
    for key, days in by_key.items():
        kept = []
        for day in sorted(days):
            if not kept or kept[-1][1] != days[day]:
                kept.append((day, days[day]))
        ends = [d for d, _ in kept[1:]] + [None]
        out += [(key, *v, day, end) for (day, v), end in zip(kept, ends)]
    return out


def test_history_and_versions(spark):
    r = random.Random(1)
    rows = [(r.choice([None, 1, 1, 1, 1, 2, 3]), r.choice([None] + [DAY + dt.timedelta(r.randrange(40))] * 9),
             r.choice([None, 1, 2]), r.choice([None, 5])) for _ in range(400)]
    seen = spark.createDataFrame(rows, "k int, day date, a int, b int").repartition(4)
    history = dimension_history(seen, ["k"], ["a", "b"], "day", "id")
    got = [tuple(x)[:-1] for x in history.collect()]
    expected = _versions(rows)
    assert sorted(got, key=repr) == sorted(expected, key=repr)
    assert history.select("id").distinct().count() == len(expected)
    facts = [(i, r.choice([None, 1, 2, 3, 9]), r.choice([None, DAY + dt.timedelta(r.randrange(-5, 60))])) for i in range(300)]
    found = lookup_version(spark.createDataFrame(facts, "n int, k int, at date"), history, [("k", "k")], "at", ["a", "b", "valid_from"])
    want = {}
    for n, k, at in facts:
        held = [v for v in expected if at and k is not None and v[0] == k and v[3] <= at and (v[4] is None or at < v[4])]
        assert len(held) <= 1
        want[n] = held[0][1:4] if held else (None, None, None)
    assert {x.n: (x.a, x.b, x.valid_from) for x in found.collect()} == want
    assert dimension_history(seen.limit(0), ["k"], ["a"], "day").collect() == []


def test_a_month_is_replaced_alone(spark, tmp_root):
    rows = [(1, dt.date(2025, 1, 5)), (2, dt.date(2025, 2, 5)), (3, dt.date(2025, 2, 6)), (4, None)]
    df = spark.createDataFrame(rows, "id int, day date")
    path = write_months(df, tmp_root, "gold", "t", "day")
    before = {f: os.listdir(f"{path}/{f}") for f in os.listdir(path) if f.startswith("in_month=")}
    assert set(before) == {"in_month=202501", "in_month=202502", "in_month=__HIVE_DEFAULT_PARTITION__"}
    write_months(df.where("id = 2").withColumn("id", F.lit(20)), tmp_root, "gold", "t", "day")
    read = read_layer(spark, tmp_root, "gold", "t", prefix="months_")
    assert sorted(x.id for x in read.collect()) == [1, 4, 20]
    after = {f: os.listdir(f"{path}/{f}") for f in before}
    assert {f for f in before if before[f] != after[f]} == {"in_month=202502"}
    with pytest.raises(ValueError):
        write_months(df.withColumn("in_month", F.lit(1)), tmp_root, "gold", "t", "day")


def test_key_checks_agree_with_one_check_each(spark):
    r = random.Random(2)
    some = lambda n, top: [(r.choice([None] + [r.randrange(top)] * 5), r.choice(["x", "y", None, ""])) for _ in range(n)]
    dim, sub = (spark.createDataFrame(some(n, 60), "k int, t string") for n in (50, 40))
    fact = spark.createDataFrame([(i % 90, *a, b[0]) for i, (a, b) in enumerate(zip(some(100, 90), some(100, 90)))],
                                 "id int, k int, t string, other int")
    hot = fact.where("id = 3").select(F.explode(F.sequence(F.lit(1), F.lit(500))).alias("n"), "*").drop("n")
    tables = {"dim": dim, "sub": sub, "fact": fact.unionByName(hot)}
    got = {x.check: x.violations for x in key_checks(tables, {"dim": ["k", "t"], "sub": "k", "fact": "id"}, [
        ("fact", "dim", ["k", "t"]), ("fact", "sub", "other"), ("sub", "dim", ["k", "t"])]).collect()}
    on = [("k", "k"), ("t", "t")]
    assert got == {
        "pk_dim": pk_violations(dim, ["k", "t"]).count(), "pk_sub": pk_violations(sub, ["k"]).count(),
        "pk_fact": pk_violations(tables["fact"], ["id"]).count(), "fk_fact_k_t": fk_violations(tables["fact"], dim, on).count(),
        "fk_fact_other": fk_violations(tables["fact"].withColumnRenamed("k", "kk"), sub, [("other", "k")]).count(),
        "fk_sub_k_t": fk_violations(sub, dim, on).count()}
    empty = key_checks({n: t.limit(0) for n, t in tables.items()}, {"dim": "k", "sub": "k"}, [("fact", "dim", "k")]).collect()
    assert [(x.check, x.violations) for x in empty] == [("pk_dim", 0), ("fk_fact_k", 0), ("pk_sub", 0)]


def test_sketches_add_up_within_their_error(spark):
    df = spark.range(60_000).select((F.col("id") % 7).alias("part"), F.xxhash64(F.col("id") % 20_000).alias("x"))
    stored = distinct_sketches(df, ["part"], "x")
    n = distinct_from_sketches(stored, []).first().n
    assert abs(n - 20_000) <= 0.024 * 20_000  # three standard errors
    parts = {r.part: r.n for r in distinct_from_sketches(stored, ["part"]).collect()}
    exact = {r.part: r.n for r in df.groupBy("part").agg(F.count_distinct("x").alias("n")).collect()}
    assert parts.keys() == exact.keys() and all(abs(parts[k] - exact[k]) <= 0.024 * exact[k] for k in exact)
