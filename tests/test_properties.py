"""Seeded property tests: many generated cases per Spark query."""

import random

import duckdb
from pyspark.sql import functions as F

from jobstar.functions import parse as P
from jobstar.functions.keys import stable_key
from jobstar.plans.catalog import sql_key

RNG = random.Random(7)
ALPHABET = "abcXYZ019 ,.-+đĐơƠệỆ́\t'\"\\"


def _text(n):
    return "".join(RNG.choice(ALPHABET) for _ in range(n))


def test_size_struct_on_generated_ranges(spark):
    cases = []
    for _ in range(400):
        a, b = RNG.randint(0, 99999), RNG.randint(0, 99999)
        sep = RNG.choice(["-", " - ", "- ", " -"])
        fa = f"{a:,}" if RNG.random() < 0.3 else str(a)
        kind = RNG.random()
        if kind < 0.5:
            cases.append((f"{fa}{sep}{b}", a, b))
        elif kind < 0.8:
            cases.append((f"{fa}+", a, None))
        else:
            cases.append((f"{fa}{sep.rstrip()}", None, None))     # open dash: unreadable part
    df = spark.createDataFrame([(t,) for t, _, _ in cases], "t string")
    got = [(r.s["min"], r.s["max"]) if r.s else (None, None)
           for r in df.select(P.size_range_struct("t").alias("s")).collect()]
    assert got == [(a, b) for _, a, b in cases]


def test_salary_reference_on_generated_ranges(spark):
    cases = [(RNG.randint(0, 999), RNG.randint(0, 999), RNG.choice(["triệu", "TRIỆU", ""])) for _ in range(300)]
    texts = [f"{a} - {b} {u}" for a, b, u in cases] + [f"tới {a} triệu" for a, _, _ in cases]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    lo, hi = P.salary_range("t")
    got = [(r[0], r[1]) for r in df.select(lo, hi).collect()]
    want = [(a * 10 ** 6, b * 10 ** 6) for a, b, _ in cases] + [(a * 10 ** 6, None) for a, _, _ in cases]
    assert got == want


def test_stable_key_agrees_with_sql_and_separates(spark):
    rows = []
    for _ in range(3000):
        rows.append(tuple(None if RNG.random() < 0.15 else _text(RNG.randint(0, 6)) for _ in range(3)))
    rows = list(dict.fromkeys(rows))                                   # distinct tuples
    df = spark.createDataFrame(rows, "a string, b string, c string")
    spark_keys = [r.k for r in df.select(stable_key(df, ["a", "b", "c"]).alias("k")).collect()]
    con = duckdb.connect()
    con.execute("CREATE TABLE t (i INTEGER, a VARCHAR, b VARCHAR, c VARCHAR)")
    con.executemany("INSERT INTO t VALUES (?, ?, ?, ?)", [(i, *r) for i, r in enumerate(rows)])
    sql_keys = [k for (k,) in con.execute(f"SELECT {sql_key('a', 'b', 'c')} FROM t ORDER BY i").fetchall()]
    assert spark_keys == sql_keys
    assert len(set(spark_keys)) == len(rows)                           # no collisions, nulls kept apart


def test_experience_digits(spark):
    ns = [RNG.randint(0, 40) for _ in range(200)]
    df = spark.createDataFrame([(f"  {n} Năm ",) for n in ns], "t string")
    assert [r[0] for r in df.select(P.experience_years("t")).collect()] == [float(n) for n in ns]
