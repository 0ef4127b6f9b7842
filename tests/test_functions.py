"""Expression tests: (input, expected) tables, incl. the probed edge cases."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from jobstar.functions import arrays as A
from jobstar.functions import dates as D
from jobstar.functions import parse as P
from jobstar.functions.keys import stable_key
from jobstar.functions.tagging import keyword_tags
from tests.helpers import plan_text


def one(spark, values, expr_fn, dtype="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {dtype}")
    return [r[0] for r in df.select(expr_fn(F.col("x"))).collect()]


def pairs(spark, values, fn, dtype="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {dtype}")
    a, b = fn(F.col("x"))
    return [(r[0], r[1]) for r in df.select(a, b).collect()]


def test_salary_reference(spark):
    got = pairs(spark, ["thỏa thuận", "negotiation", None, "10 - 20 triệu", "tới 30 triệu",
                        "trên 15 triệu", "12.5 - 20 triệu", "1,000 - 2,000 usd", "3000 usd",
                        "Thỏa Thuận"], P.salary_range)
    M = 1_000_000
    assert got == [(None, None), (None, None), (None, None), (10 * M, 20 * M), (30 * M, None),
                   (15 * M, None), (12 * M, 20 * M), (1 * M, 2 * M), (3000 * M, None),
                   (None, None)]


def test_salary_fixed(spark):
    got = pairs(spark, ["10 - 20 triệu", "tới 30 triệu", "trên 15 triệu", "12.5 - 20 triệu",
                        "1,000 - 2,000 usd", "3000 usd", "negotiable", "Thoả thuận", None],
                lambda c: P.salary_range(c, mode="fixed"))
    M = 1_000_000
    assert got == [(10 * M, 20 * M), (None, 30 * M), (15 * M, None), (12_500_000, 20 * M),
                   (24_000_000, 48_000_000), (72_000_000, None), (None, None), (None, None),
                   (None, None)]


def test_experience(spark):
    got = one(spark, ["không yêu cầu kinh nghiệm", "Trên 5 năm", "3 năm", "dưới 1 năm", "abc", None],
              P.experience_years)
    assert got == [0.0, 5.5, 3.0, 1.0, None, None]


def test_size_range_reference(spark):
    got = pairs(spark, ["100-499 nhân viên", "1000+ nhân viên", "10 nhân viên", None, "1,000+",
                        "25 - 99"], P.size_range)
    # the last one aborts the source job under ANSI; here it is null
    assert got == [(100, 499), (1000, 1000), (10, 10), (None, None), (1, 1), (25, None)]


def test_size_range_fixed(spark):
    got = pairs(spark, ["100-499 nhân viên", "1000+ nhân viên", "1,000+", "25 - 99", "1.000-5.000"],
                lambda c: P.size_range(c, mode="fixed"))
    assert got == [(100, 499), (1000, None), (1000, None), (25, 99), (1000, 5000)]


def test_size_range_struct(spark):
    got = one(spark, ["100-499", "1,000+", "500-", "25 - 99", "", None, "abc", "1-2-3", "-5"],
              P.size_range_struct)
    as_t = [None if r is None else (r["min"], r["max"]) for r in got]
    assert as_t == [(100, 499), (1000, None), None, (25, 99), None, None, None, (1, 2), None]


def test_currency(spark):
    df = spark.createDataFrame([(100, "USD"), (0, "USD"), (None, "VND"), (5, "VND"), (7, "EUR"),
                                (3, None)], "a bigint, c string")
    got = [r[0] for r in df.select(P.currency_to_vnd("a", "c")).collect()]
    assert got == [2_400_000, None, None, 5, None, None]


def test_decode_work_form(spark):
    assert one(spark, [1, 2, None], P.decode_work_form, "int") == [
        P.FULL_TIME, P.PART_TIME, P.PART_TIME]
    assert one(spark, [1, 2, None], lambda c: P.decode_work_form(c, null_is_part_time=False), "int") == [
        P.FULL_TIME, P.PART_TIME, None]


def test_district(spark):
    vals = ["12 Lê Lợi, Quận Tân Bình, HCM", "Q. Bình Thạnh", "Quận 1, HCM", "QUẬN Tân Phú",
            "123 abc", None]
    assert one(spark, vals, A.district_from_address) == ["Tân Bình", "Bình Thạnh", " ", "", "", None]
    assert one(spark, vals, lambda c: A.district_from_address(c, "fixed")) == [
        "Tân Bình", "Bình Thạnh", None, "Tân Phú", None, None]


def test_dates(spark):
    assert one(spark, ["Hạn nộp hồ sơ: 30/08/2025", "2025-07-24", None], D.deadline_to_date) == [
        dt.date(2025, 8, 30), None, None]
    assert one(spark, ["2025-07-24T10:00:00+07:00", "2025-07-24", "x"], D.parse_iso_date) == [
        dt.date(2025, 7, 24), dt.date(2025, 7, 24), None]


def test_headcount(spark):
    assert one(spark, ["3 người", "Nhiều", None], P.headcount) == [3, None, None]


def test_array_ops(spark):
    df = spark.createDataFrame([(["IT", "a", None, "IT"],), (None,), ([],)], "x array<string>")
    got = [r[0] for r in df.select(A.clean_list("x", "IT")).collect()]
    assert got == [["a", None], None, []]
    got = [(r[0], r[1]) for r in df.select(*A.city_district("x")).collect()]
    assert got == [("IT", "a"), (None, None), (None, None)]


def test_struct_first_and_project(spark):
    df = spark.createDataFrame([([{"n": "a"}, None],), ([],), (None,)], "x array<struct<n:string>>")
    got = [(r[0], r[1]) for r in df.select(A.field_of_first("x", "n"), A.project_field("x", "n")).collect()]
    assert got == [("a", ["a", None]), (None, []), (None, None)]


def test_keyword_tags(spark):
    got = one(spark, ["Python, SQL, Spark and JavaScript", "", None, "Git for digital",
                      "C# and C++ REST api"], keyword_tags)
    assert got[0] == ["python", "java", "sql", "javascript", "spark"]   # substring: java
    assert got[1] == [] and got[2] == []
    assert got[3] == ["git"]                                            # "digital" too
    assert got[4] == ["rest", "c#", "c++", "api"]


def test_keyword_tags_word_boundary(spark):
    got = one(spark, ["Python, SQL, Spark and JavaScript", "digital"],
              lambda c: keyword_tags(c, word_boundary=True))
    assert got == [["python", "sql", "javascript", "spark"], []]


def test_stable_key_nulls_and_arrays(spark):
    df = spark.createDataFrame([("a", None, "d"), (None, "a", "d"), ("a", None, "d")], "x string, y string, z string")
    ks = [r[0] for r in df.select(stable_key(df, ["x", "y", "z"])).collect()]
    assert ks[0] != ks[1] and ks[0] == ks[2] and all(0 <= k < 2 ** 60 for k in ks)
    arr = spark.createDataFrame([([],), (None,), ([None],), (["a"],)], "x array<string>")
    ks = [r[0] for r in arr.select(stable_key(arr, ["x"])).collect()]
    assert len(set(ks)) == 4


@pytest.mark.parametrize("mode", ["reference", "fixed"])
def test_no_python_udf_in_parsers(spark, mode):
    df = spark.createDataFrame([("10 - 20 triệu",)], "x string")
    lo, hi = P.salary_range("x", mode)
    plan = plan_text(df.select(lo, hi, keyword_tags("x"), P.size_range_struct("x")))
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
