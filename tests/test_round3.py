"""Array files in blocks, snapshots, incremental keep-latest, as-of rates."""

import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from jobstar.operators.asof import asof_lookup, to_base_currency
from jobstar.operators.dedup import latest_per_key
from jobstar.sources import snapshots
from jobstar.sources.arrays import array_elements, quotes
from jobstar.sources.readers import read_raw_records

RECORD = StructType([StructField("id", LongType()), StructField("s", StringType()), StructField("v", DoubleType())])


@pytest.fixture()
def small_blocks(spark):
    """Blocks of a few hundred bytes."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    old = [spark.conf.get(n) for n in names]
    for n, v in zip(names, ("300", "1")):
        spark.conf.set(n, v)
    yield
    for n, v in zip(names, old):
        spark.conf.set(n, v)


def records(n: int, seed: int) -> list:
    """Records full of braces, brackets, quotes and backslashes in strings, some longer than a block."""
    r = random.Random(seed)
    odd = ['"', "\\", "{", "}", "[", "]", ",", "é", "\n", "x", '\\"', "}{", "],["]

    def text() -> str:
        return "".join(r.choice(odd) for _ in range(r.choice([0, 3, 20, 20, 900])))

    return [{"id": i, "s": text(), "v": r.choice([1.5, "n/a", None]), "deep": [{"a": text(), "b": [[], {}]}]} for i in range(n)]


def written(folder: str, name: str, text: str) -> None:
    import os
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w", encoding="utf-8", newline="") as f:
        f.write(text)


def test_quotes():
    for t in ('"a\\"b\\\\" "', '\\\\"\\"', ""):
        expected, escaped = [], False
        for c in t:
            expected.append(c == '"' and not escaped)
            escaped = c == "\\" and not escaped
        assert quotes(np.frombuffer(t.encode(), np.uint8)).tolist() == expected


@pytest.mark.parametrize("seed", [1, 2])
def test_array_files_in_blocks(spark, tmp_root, small_blocks, seed):
    rows = {"a.json": records(40, seed), "b.json": records(3, seed + 10), "empty.json": []}
    for name, r in rows.items():
        written(f"{tmp_root}/raw", name, json.dumps(r, indent=random.Random(seed).choice([None, 2]), ensure_ascii=False))
    assert spark.read.text(f"{tmp_root}/raw", lineSep="}").rdd.getNumPartitions() > 20
    one = read_raw_records(spark, f"{tmp_root}/raw", RECORD)
    many = read_raw_records(spark, f"{tmp_root}/raw", RECORD, split=True)
    assert many.dtypes == one.dtypes
    key = lambda df: sorted(map(repr, (r.asDict() for r in df.collect())))
    assert key(many) == key(one)
    assert many.count() == 43


def test_damaged_array_files(spark, tmp_root, small_blocks):
    good = records(30, 5)
    text = json.dumps(good, ensure_ascii=False)
    at = [text.index(json.dumps(r, ensure_ascii=False)) for r in good]
    written(f"{tmp_root}/raw", "cut.json", text[:at[20] + 9])  # ends within a record
    written(f"{tmp_root}/raw", "brace.json", text[:text.index("}", at[20]) + 1])  # ends with a brace, perhaps within a record
    written(f"{tmp_root}/raw", "object.json", '{"id": 7, "s": "alone", "v": 2}')
    written(f"{tmp_root}/raw", "none.json", "no JSON at all")
    written(f"{tmp_root}/raw", "mixed.json", '﻿ [ 1, {"id": 8} ,, {"id": 9, "s": oops}, {"id": 10} ] ')
    out = {}
    for r in read_raw_records(spark, f"{tmp_root}/raw", RECORD, split=True).collect():
        out.setdefault(r.source_file.rsplit("/", 1)[1], []).append((r.id, r._corrupt_record is not None))
    out = {k: sorted(v, key=lambda x: (x[0] is None, x)) for k, v in out.items()}
    assert out["cut.json"] == [(i, False) for i in range(20)] + [(None, True)]
    assert [x for x in out["brace.json"] if x[0] is not None and x[0] < 20] == [(i, False) for i in range(20)]
    assert out["object.json"] == [(7, False)] and out["none.json"] == [(None, True)]
    assert out["mixed.json"] == [(8, False), (10, False), (None, False), (None, True), (None, True)]


def test_compressed_array_file(spark, tmp_root):
    import gzip
    import os
    os.makedirs(f"{tmp_root}/raw")
    with gzip.open(f"{tmp_root}/raw/a.json.gz", "wt", encoding="utf-8") as f:
        json.dump(records(20, 3), f)
    assert sorted(json.loads(r.value)["id"] for r in array_elements(spark, f"{tmp_root}/raw").collect()) == list(range(20))


# ---- snapshots

def frames(spark, n: int) -> dict:
    return {"dim": spark.range(n).toDF("k"), "fact": spark.range(10 * n).select((F.col("id") % n).alias("k"))}


def test_publish_is_all_or_nothing(spark, tmp_root):
    root = f"{tmp_root}/gold"
    assert snapshots.versions(spark, root) == [] and snapshots.publish(spark, root, frames(spark, 3)) == 1
    seen = []

    class Slow(dict):
        """Reads the published tables between two writes."""

        def items(self):
            for name, df in super().items():
                yield name, df
                seen.append({n: t.count() for n, t in snapshots.read_snapshot(spark, root).items()})

    assert snapshots.publish(spark, root, Slow(frames(spark, 5))) == 2
    assert seen == [{"dim": 3, "fact": 30}] * 2
    assert {n: t.count() for n, t in snapshots.read_snapshot(spark, root).items()} == {"dim": 5, "fact": 50}
    assert {n: t.count() for n, t in snapshots.read_snapshot(spark, root, version=1).items()} == {"dim": 3, "fact": 30}

    broken = frames(spark, 7) | {"zz": spark.range(3).select(F.raise_error(F.lit("killed")).alias("x"))}
    with pytest.raises(Exception, match="killed"):
        snapshots.publish(spark, root, broken)
    assert snapshots.versions(spark, root) == [1, 2]
    assert snapshots.read_snapshot(spark, root)["dim"].count() == 5
    # a later version may replace some tables
    assert snapshots.publish(spark, root, {"dim": spark.range(1).toDF("k")}) == 3
    assert {n: t.count() for n, t in snapshots.read_snapshot(spark, root).items()} == {"dim": 1, "fact": 50}


def test_second_writer_of_a_version_fails(spark, tmp_root):
    root = f"{tmp_root}/gold"
    snapshots.publish(spark, root, frames(spark, 2))
    old = snapshots.manifest(spark, root)
    snapshots.publish(spark, root, frames(spark, 4))
    with pytest.raises(snapshots.Conflict):
        snapshots._commit(spark, root, old | {"version": 2})
    assert snapshots.read_snapshot(spark, root)["dim"].count() == 4


def test_expire(spark, tmp_root):
    import os
    root = f"{tmp_root}/gold"
    for n in (1, 2, 3):
        snapshots.publish(spark, root, frames(spark, n) if n < 3 else {"dim": frames(spark, n)["dim"]})
    gone = snapshots.expire(spark, root, keep=1)
    assert len(gone) == 3 and not any(os.path.exists(g) for g in gone)  # the fact of version 2 is still that of 3
    assert snapshots.versions(spark, root) == [3]
    assert {n: t.count() for n, t in snapshots.read_snapshot(spark, root).items()} == {"dim": 3, "fact": 20}


# ---- keep-latest by instalments

def postings(spark, seed: int, n: int):
    r = random.Random(seed)
    rows = [(r.choice([None, *range(40)]), r.choice(["x", "y", None]), r.choice([None, *range(8)]), r.randrange(5)) for _ in range(n)]
    return spark.createDataFrame(rows, "k int, k2 string, day int, v int")


def test_fold_equals_one_pass(spark, tmp_root):
    parts = [postings(spark, s, n) for s, n in ((1, 150), (2, 90), (3, 200))]
    root = f"{tmp_root}/silver"
    for i, p in enumerate(parts):
        assert snapshots.fold_latest(spark, root, "jobs", p, ["k", "k2"], ["day"], buckets=8, batch=i) == i + 1
    every = parts[0].unionByName(parts[1]).unionByName(parts[2])
    key = lambda df: sorted(map(repr, df.select("k", "k2", "day", "v").collect()))
    table = lambda: key(snapshots.read_snapshot(spark, root, ["jobs"])["jobs"])
    assert table() == key(latest_per_key(every, ["k", "k2"], ["day"]))
    before = snapshots.manifest(spark, root)
    assert snapshots.fold_latest(spark, root, "jobs", parts[1], ["k", "k2"], ["day"], batch=1) is None  # a rerun
    assert snapshots.manifest(spark, root) == before
    snapshots.fold_latest(spark, root, "jobs", parts[1], ["k", "k2"], ["day"])  # the same rows again, under no number
    assert table() == key(latest_per_key(every, ["k", "k2"], ["day"]))


def test_fold_leaves_other_parts_alone(spark, tmp_root):
    root = f"{tmp_root}/silver"
    snapshots.fold_latest(spark, root, "jobs", postings(spark, 1, 300), ["k", "k2"], ["day"], buckets=16)
    before = snapshots.manifest(spark, root)["tables"]["jobs"]
    one = spark.createDataFrame([(5, "x", 99, 1)], "k int, k2 string, day int, v int")
    snapshots.fold_latest(spark, root, "jobs", one, ["k", "k2"], ["day"])
    after = snapshots.manifest(spark, root)["tables"]["jobs"]
    assert len(before) > 8 and sum(before[p] != after[p] for p in before) == 1
    rows = snapshots.read_snapshot(spark, root)["jobs"]
    assert rows.where("k = 5 AND k2 = 'x'").select("day").collect()[0].day == 99
    empty = one.limit(0)
    snapshots.fold_latest(spark, root, "jobs", empty, ["k", "k2"], ["day"])
    assert snapshots.manifest(spark, root)["tables"]["jobs"] == after


def test_fold_new_files(spark, tmp_root):
    src, root, ckpt = f"{tmp_root}/bronze", f"{tmp_root}/silver", f"{tmp_root}/ckpt"
    snapshots.fold_new_files(spark, src, ckpt, root, "jobs", ["k"], ["day"])  # nothing has come
    assert snapshots.versions(spark, root) == []
    parts = [postings(spark, s, 60) for s in (1, 2)]
    for p in parts:
        p.write.mode("append").parquet(src)
        for _ in range(2):  # the second call finds no new file
            snapshots.fold_new_files(spark, src, ckpt, root, "jobs", ["k"], ["day"], buckets=4)
    assert snapshots.versions(spark, root) == [1, 2]
    expected = latest_per_key(parts[0].unionByName(parts[1]), ["k"], ["day"])
    got = snapshots.read_snapshot(spark, root)["jobs"]
    assert sorted(map(repr, got.select("k", "k2", "day", "v").collect())) == sorted(map(repr, expected.collect()))


def test_pipeline_by_instalments(spark, tmp_root):
    """Silver folded from instalments, and the eight gold tables published at once, as from one batch."""
    from jobstar.plans import pipeline
    from tests.helpers import posting_a, posting_b, write_json_array
    day = lambda i: f"Hạn nộp hồ sơ: {i % 27 + 1:02}/08/2025"
    a = [posting_a(id=str(i), title=f"Job {i % 7}", deadline_submit=day(i)) for i in range(20)]
    b = [posting_b(jobTitle=f"Job {i % 5}", approvedOn=f"2025-07-{i + 1:02}T10:00:00+07:00") for i in range(20)]
    for i, (lo, hi) in enumerate(((0, 8), (8, 9), (9, 20))):
        write_json_array(f"{tmp_root}/a{i}/x.json", a[lo:hi])
        write_json_array(f"{tmp_root}/b{i}/x.json", b[lo:hi])
        pipeline.run_bronze(spark, f"{tmp_root}/a{i}", f"{tmp_root}/b{i}", f"{tmp_root}/lake", append=True)
        pipeline.fold_silver(spark, f"{tmp_root}/lake", buckets=4)
        assert pipeline.run_gold_snapshot(spark, f"{tmp_root}/lake") == i + 1
    pipeline.fold_silver(spark, f"{tmp_root}/lake", buckets=4)
    folded = snapshots.read_snapshot(spark, f"{tmp_root}/lake/silver_snapshots")
    pipeline.run_silver(spark, f"{tmp_root}/lake")
    for source in (pipeline.SOURCE_A, pipeline.SOURCE_B):
        whole = pipeline.read_layer(spark, f"{tmp_root}/lake", "silver", source)
        assert sorted(map(repr, folded[source].collect())) == sorted(map(repr, whole.select(*folded[source].columns).collect()))
    pipeline.run_gold(spark, f"{tmp_root}/lake")
    gold = snapshots.read_snapshot(spark, f"{tmp_root}/lake/gold_snapshots")
    assert set(gold) == set(pipeline.GOLD_NAMES)
    for name, t in gold.items():
        whole = pipeline.read_layer(spark, f"{tmp_root}/lake", "gold", name)
        assert sorted(map(repr, t.collect())) == sorted(map(repr, whole.select(*t.columns).collect()))


# ---- as-of rates

def test_asof_equals_brute_force(spark):
    r = random.Random(3)
    facts = [(i, r.choice(["USD"] * 6 + ["EUR", None, "XXX"]), r.choice([None, *range(30)])) for i in range(400)]
    rates = [(r.choice(["USD", "EUR", "GBP", None]), r.choice([None, *range(5, 30)]), r.randrange(100)) for _ in range(60)]
    df = spark.createDataFrame(facts, "i int, ccy string, day int").withColumn("rate", F.lit("mine")).repartition(5)
    dated = spark.createDataFrame(rates, "currency string, since int, rate int")
    expected = []
    for i, ccy, day in facts:
        known = [(s, x) for c, s, x in rates if None not in (c, s, day, ccy) and c == ccy and s <= day]
        expected.append((i, ccy, day, max(known)[1] if known else None))
    for salts in (1, 7):
        out = asof_lookup(df, dated, [("ccy", "currency")], "day", "since", ["rate"], salts)
        assert out.columns == ["i", "ccy", "day", "rate"]
        assert sorted(map(tuple, out.collect()), key=lambda x: x[0]) == expected
    assert asof_lookup(df.limit(0), dated, [("ccy", "currency")], "day", "since", ["rate"]).collect() == []
    assert asof_lookup(df, dated.limit(0), [("ccy", "currency")], "day", "since", ["rate"]).where("rate IS NOT NULL").count() == 0


def test_asof_deals_a_hot_key_over_tasks(spark):
    df = spark.range(4000).select(F.lit("USD").alias("ccy"), (F.col("id") % 50).alias("day"))
    dated = spark.range(50).select(F.lit("USD").alias("currency"), F.col("id").alias("since"), F.col("id").alias("rate"))
    out = asof_lookup(df, dated, [("ccy", "currency")], "day", "since", ["rate"])
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        per = [r[1] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(per) == 4000 and len(per) > 4 and max(per) < 2400
    assert out.where("rate <> day").count() == 0


def test_rates(spark):
    rates = spark.createDataFrame([("USD", 1, 24000), ("USD", 9, 25000)], "currency string, rate_date int, rate bigint")
    df = spark.createDataFrame([(10, "USD", 0), (10, "USD", 5), (10, "USD", 9), (7, "VND", 0), (0, "VND", 1), (None, "USD", 9),
                                (10, "EUR", 9), (2 ** 62, "USD", 9)], "a bigint, c string, d int")
    out = [r.amount_vnd for r in to_base_currency(df, "a", "c", "d", rates).orderBy("a", "c", "d").collect()]
    assert sorted(x for x in out if x is not None) == [7, 240000, 250000] and len(out) == 8
