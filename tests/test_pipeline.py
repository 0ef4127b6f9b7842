"""Stage tests: bronze fixtures -> silver -> gold, schemas and invariants."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from jobstar import schemas
from jobstar.operators.checks import fk_violations, pk_violations
from jobstar.plans import pipeline
from jobstar.plans.gold import gold_tables, gold_view
from jobstar.plans.silver import silver_board_a, silver_board_b
from jobstar.sources.readers import read_json_records, read_layer
from tests.helpers import posting_a, posting_b, write_json_array


def _fixtures(root):
    a = [
        posting_a(),
        # same (title, company) later deadline -> kept by dedup
        posting_a(id="1", deadline_submit="Hạn nộp hồ sơ: 15/09/2025", salary="Thỏa thuận"),
        posting_a(id="2", title="ML Engineer", requirements="", company_size="1000+ nhân viên"),
        posting_a(id="3", title="BI Analyst", yoe="Trên 5 năm", salary="tới 30 triệu",
                  company_size="25 - 99", num_of_recruit="Nhiều", area=["Hồ Chí Minh"],
                  requirements="Java, Git, api", deadline_submit="2025-07-24"),
    ]
    b = [
        posting_b(),
        posting_b(jobTitle="Analyst", salaryCurrency="VND", salaryMin=0, salaryMax=30000000,
                  companySize="500-", typeWorkingId=None, workingLocations=[], skills=None,
                  approvedOn="x"),
    ]
    pa = write_json_array(os.path.join(root, "raw_a", "a1.json"), a)
    pb = write_json_array(os.path.join(root, "raw_b", "b1.json"), b)
    return os.path.dirname(pa), os.path.dirname(pb)


def test_silver_a(spark, tmp_root):
    ra, _ = _fixtures(tmp_root)
    bronze = read_json_records(spark, ra, schemas.BRONZE_A)
    s = silver_board_a(bronze)
    assert s.schema.simpleString() == schemas.SILVER.simpleString()
    rows = {r.job_position: r for r in s.collect()}
    assert set(rows) == {"data engineer", "bi analyst"}        # ML dropped: blank requirements
    de = rows["data engineer"]
    assert de.job_posting_date == dt.date(2025, 9, 15)         # latest kept
    assert de.min_salary is None and de.company_name == "Công ty A"
    assert de.relation_fields == ["Data"] and de.city == "Hà Nội" and de.district == "Cầu Giấy"
    assert de.skills_extracted == ["python", "sql", "spark"]
    bi = rows["bi analyst"]
    assert bi.yoe == 5.5 and bi.min_salary == 30_000_000 and bi.max_salary is None
    assert (bi.company_size_min, bi.company_size_max) == (25, None)
    assert bi.num_of_recruit is None and bi.job_posting_date is None and bi.district is None
    assert bi.skills_extracted == ["java", "git", "api"]


def test_silver_b(spark, tmp_root):
    _, rb = _fixtures(tmp_root)
    s = silver_board_b(read_json_records(spark, rb, schemas.BRONZE_B))
    assert s.schema.simpleString() == schemas.SILVER.simpleString()
    rows = {r.job_position: r for r in s.collect()}
    de = rows["Data Engineer"]
    assert (de.min_salary, de.max_salary) == (24_000_000, 48_000_000)
    assert (de.company_size_min, de.company_size_max) == (1000, None)
    assert de.work_form == "Toàn thời gian" and de.district == "Tân Bình"
    assert de.relation_fields == ["Data", "BI"] and de.skills_extracted == ["Python", " SQL "]
    an = rows["Analyst"]
    assert an.min_salary is None and an.max_salary == 30_000_000
    assert an.company_size_min is None and an.work_form == "Bán thời gian"
    assert an.city is None and an.district is None and an.job_posting_date is None


def test_gold_end_to_end(spark, tmp_root):
    ra, rb = _fixtures(tmp_root)
    root = os.path.join(tmp_root, "lake")
    out = pipeline.run_all(spark, ra, rb, root)
    assert set(out["gold"]) == set(pipeline.GOLD_NAMES)
    g = {n: read_layer(spark, root, "gold", n) for n in pipeline.GOLD_NAMES}
    for n, sch in schemas.GOLD.items():
        assert g[n].schema.simpleString() == sch.simpleString(), n
    view = g["view"]
    assert view.count() == 4
    fact = g["fact_job"]
    assert fact.count() == view.count()                      # no fan-out
    # every foreign key resolves
    assert fk_violations(fact, g["dim_company"], [("CompanyID", "CompanyID")]).count() == 0
    assert fk_violations(fact, g["dim_jobposition"], [("JobPositionID", "JobPositionID")]).count() == 0
    assert fk_violations(fact, g["dim_workform"], [("WorkFormID", "WorkFormID")]).count() == 0
    assert fk_violations(g["fact_jobskill"], g["dim_skills"], [("SkillID", "SkillID")]).count() == 0
    for n, k in [("dim_company", "CompanyID"), ("dim_jobposition", "JobPositionID"),
                 ("dim_workform", "WorkFormID"), ("dim_skills", "SkillID"), ("dim_date", "DateID")]:
        assert pk_violations(g[n], [k]).count() == 0, n
    skills = {r.SkillName for r in g["dim_skills"].collect()}
    assert {"SQL", "Python", "python"} <= skills              # trimmed, case kept


def test_fact_join_equals_derive(spark, tmp_root):
    ra, rb = _fixtures(tmp_root)
    view = gold_view([silver_board_a(read_json_records(spark, ra, schemas.BRONZE_A)),
                      silver_board_b(read_json_records(spark, rb, schemas.BRONZE_B))])
    a = gold_tables(view, "derive")
    b = gold_tables(view, "join")
    for n in ["fact_job", "fact_jobskill"]:
        assert sorted(a[n].collect(), key=repr) == sorted(b[n].collect(), key=repr), n


def test_keys_stable_across_partitioning(spark, tmp_root):
    ra, rb = _fixtures(tmp_root)
    view = gold_view([silver_board_a(read_json_records(spark, ra, schemas.BRONZE_A)),
                      silver_board_b(read_json_records(spark, rb, schemas.BRONZE_B))])
    results = []
    for n in (1, 7, 64):
        spark.conf.set("spark.sql.shuffle.partitions", str(n))
        t = gold_tables(view.repartition(n))
        results.append({k: sorted(v.collect(), key=repr) for k, v in t.items()})
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert results[0] == results[1] == results[2]


def test_fanout_fixed(spark):
    """Company with two fields. A join on the name alone gives 5 rows;
    the full-key lookup keeps 3."""
    from jobstar.operators.joins import lookup
    from jobstar.operators.star import build_dimension
    df = spark.createDataFrame([("A", "IT", 1), ("A", "Sales", 2), ("B", "IT", 3)],
                               "company_name string, major_field string, p int")
    dim = build_dimension(df, {"CompanyName": "company_name", "MajorField": "major_field"}, "CompanyID")
    naive = df.join(dim, df.company_name == dim.CompanyName, "left")
    assert naive.count() == 5                  # each "A" row matches both "A" rows
    fixed = lookup(df, dim, [("company_name", "CompanyName"), ("major_field", "MajorField")], ["CompanyID"])
    assert fixed.count() == 3 and fixed.filter(F.col("CompanyID").isNull()).count() == 0


def test_explode_drops_null_and_empty(spark):
    from jobstar.operators.star import explode_items
    df = spark.createDataFrame([(1, []), (2, None), (3, [" x "])], "id int, a array<string>")
    assert [tuple(r) for r in explode_items(df, ["id"], "a", "v").collect()] == [(3, "x")]


def test_land_skips_empty(spark, tmp_root):
    from jobstar.sources.sinks import land_bronze
    df = spark.createDataFrame([(1,)], "x int")
    out = land_bronze({"full": df, "empty": df.filter("x > 5"), "missing": None}, tmp_root)
    assert list(out) == ["full"]
    assert read_layer(spark, tmp_root, "bronze", "full").count() == 1


def test_publish_tables(spark, tmp_root):
    ra, rb = _fixtures(tmp_root)
    root = os.path.join(tmp_root, "lake")
    pipeline.run_bronze(spark, ra, rb, root)
    pipeline.run_silver(spark, root)
    pipeline.run_gold(spark, root)
    names = pipeline.publish(spark, root, path_root=os.path.join(tmp_root, "wh"))
    assert len(names) == 8
    assert spark.table("fact_job").count() == 4


def test_quality_report_counts_dirty_text(spark, tmp_root):
    from jobstar.plans.silver import silver_quality_a
    ra, _ = _fixtures(tmp_root)
    rep = {r.check: (r.rows, r.failures)
           for r in silver_quality_a(read_json_records(spark, ra, schemas.BRONZE_A)).collect()}
    # "Thỏa thuận" is an expected null; "2025-07-24" is not day-first; "Nhiều" is no number
    assert rep == {"salary": (4, 0), "yoe": (4, 0), "deadline": (4, 1), "company_size": (4, 0),
                   "headcount": (4, 1)}


def test_union_widens_types(spark):
    from jobstar.operators.conform import union_sources
    a = spark.createDataFrame([(1, 2)], "x int, y bigint")
    b = spark.createDataFrame([(3, 4.5)], "x bigint, y double")
    u = union_sources([a, b])
    assert dict(u.dtypes) == {"x": "bigint", "y": "double"} and u.count() == 2


def test_to_schema_strict_and_try_cast(spark):
    import pytest as _pt
    from pyspark.sql.types import IntegerType, StructField, StructType
    from jobstar.operators.conform import to_schema
    df = spark.createDataFrame([("12",), ("x",)], "n string")
    sch = StructType([StructField("n", IntegerType())])
    assert [r.n for r in to_schema(df, sch).collect()] == [12, None]
    with _pt.raises(ValueError):
        to_schema(df, StructType([StructField("m", IntegerType())]))


def test_load_jdbc_embedded(spark, tmp_root):
    """A9 over JDBC into an in-process Derby database (no server, no port)."""
    from jobstar.sources.sinks import load_jdbc
    ra, rb = _fixtures(tmp_root)
    root = os.path.join(tmp_root, "lake")
    pipeline.run_all(spark, ra, rb, root)
    url = f"jdbc:derby:{os.path.join(tmp_root, 'derby')};create=true"
    tables = {n: read_layer(spark, root, "gold", n) for n in ["fact_job", "dim_jobposition"]}
    load_jdbc(spark, tables, url, options={"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"},
              max_connections=2)
    back = spark.read.jdbc(url, "fact_job", properties={"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"})
    assert back.count() == tables["fact_job"].count()
    pos = spark.read.jdbc(url, "dim_jobposition", properties={"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"})
    assert pos.count() == tables["dim_jobposition"].count()


def test_object_store_conf():
    from jobstar.session import object_store_conf
    c = object_store_conf("http://store:9000")
    assert c["spark.hadoop.fs.s3a.path.style.access"] == "true"
    assert c["spark.hadoop.fs.s3a.connection.ssl.enabled"] == "false"
    assert not any("secret" in k or "access.key" in k for k in c)


def test_murmur3_posting_key_matches_source_hash(spark, tmp_root):
    ra, _ = _fixtures(tmp_root)
    s = silver_board_a(read_json_records(spark, ra, schemas.BRONZE_A))
    v = gold_view([s], posting_key="murmur3")
    want = s.select(F.hash("company_name", "job_position", "job_posting_date").cast("string").alias("k"))
    assert sorted(r.JobPostingID for r in v.collect()) == sorted(r.k for r in want.collect())


def test_silver_fixed_modes(spark, tmp_root):
    ra, rb = _fixtures(tmp_root)
    a = {r.job_position: r for r in
         silver_board_a(read_json_records(spark, ra, schemas.BRONZE_A), mode="fixed").collect()}
    bi = a["bi analyst"]
    assert (bi.min_salary, bi.max_salary) == (None, 30_000_000)          # "tới" = up to
    assert (bi.company_size_min, bi.company_size_max) == (25, 99)          # spaces around '-'
    b_raw = read_json_records(spark, rb, schemas.BRONZE_B)
    b_raw = b_raw.unionByName(b_raw.withColumn("jobTitle", F.lit(" DATA engineer "))
                                   .withColumn("approvedOn", F.lit("2025-08-01T00:00:00+07:00"))
                                   .limit(1))
    b = silver_board_b(b_raw, mode="fixed").collect()
    titles = sorted(r.job_position for r in b)
    assert titles == ["analyst", "data engineer"]                          # keys folded -> one kept
    de = [r for r in b if r.job_position == "data engineer"][0]
    assert de.job_posting_date == dt.date(2025, 8, 1) and de.district == "Tân Bình"


def test_silver_normalizes_decomposed_text(spark, tmp_root):
    import unicodedata
    nfd = lambda t: unicodedata.normalize("NFD", t)
    path = write_json_array(os.path.join(tmp_root, "nfd", "a.json"), [posting_a(
        salary=nfd("Thỏa thuận"), yoe=nfd("Không yêu cầu kinh nghiệm"),
        deadline_submit=nfd("Hạn nộp hồ sơ: 30/08/2025"), num_of_recruit=nfd("3 người"))])
    bronze = read_json_records(spark, os.path.dirname(path), schemas.BRONZE_A)
    raw = silver_board_a(bronze).first()
    assert raw.yoe is None and raw.job_posting_date is None            # decomposed text is missed
    fixed = silver_board_a(bronze, normalize=True).first()
    assert fixed.yoe == 0.0 and fixed.job_posting_date == dt.date(2025, 8, 30)
    assert fixed.num_of_recruit == 3 and fixed.min_salary is None


def test_gold_options(spark, tmp_root):
    ra, rb = _fixtures(tmp_root)
    a = silver_board_a(read_json_records(spark, ra, schemas.BRONZE_A))
    b_raw = read_json_records(spark, rb, schemas.BRONZE_B).withColumn("companyName", F.lit("Công ty A "))
    b = silver_board_b(b_raw, mode="fixed")
    view = gold_view([a, b], date_kind=True)
    kinds = {(r.source, r.date_kind) for r in view.collect()}
    assert kinds == {("topcv", "deadline"), ("vietnamworks", "approved")}
    # "data engineer" is on both boards: kept twice by default, once across sources
    assert view.filter(F.col("job_position") == "data engineer").count() == 2
    across = gold_view([a, b], latest_across_sources=True)
    kept = across.filter(F.col("job_position") == "data engineer").collect()
    assert len(kept) == 1 and kept[0].source == "topcv"          # 2025-09-15 beats 2025-07-24
    folded = gold_tables(gold_view([a, b]), fold_skills=True)
    names = {r.SkillName for r in folded["dim_skills"].collect()}
    assert "Python" in names and "python" not in names and "SQL" in names
    assert fk_violations(folded["fact_jobskill"], folded["dim_skills"], [("SkillID", "SkillID")]).count() == 0
    assert pk_violations(folded["dim_skills"], ["SkillID"]).count() == 0


def test_cli_stages(spark, tmp_root):
    from jobstar.__main__ import main
    ra, rb = _fixtures(tmp_root)
    root = os.path.join(tmp_root, "cli-lake")
    assert set(main(["bronze", "--raw-a", ra, "--raw-b", rb, "--root", root])) == {"topcv", "vietnamworks"}
    main(["silver", "--root", root, "--mode", "fixed"])
    out = main(["gold", "--root", root])
    assert set(out) == set(pipeline.GOLD_NAMES)
    assert read_layer(spark, root, "gold", "fact_job").count() == 4


def test_bronze_skips_missing_source(spark, tmp_root):
    ra, _ = _fixtures(tmp_root)
    out = pipeline.run_bronze(spark, ra, os.path.join(tmp_root, "does-not-exist"), os.path.join(tmp_root, "lk"))
    assert list(out) == ["topcv"]


@pytest.mark.parametrize("missing", ["a", "b", "a-empty"])
def test_one_board_alone(spark, tmp_root, missing):
    ra, rb = _fixtures(tmp_root)
    if missing == "a-empty":
        write_json_array(os.path.join(ra, "a1.json"), [])
    raw = (None if missing == "a" else ra, None if missing == "b" else rb)
    out = pipeline.run_all(spark, *raw, os.path.join(tmp_root, "lake-one"))
    assert list(out["silver"]) == (["topcv"] if missing == "b" else ["vietnamworks"])
    assert set(out["gold"]) == set(pipeline.GOLD_NAMES)


def test_badly_typed_values_lose_nothing_else(spark, tmp_root):
    from jobstar.sources.readers import raw_quality
    records = [posting_b(jobTitle=f"J{i}", jobId=i, benefits=["x"]) for i in range(4)]
    records[1]["salaryMin"] = 1500.5
    records[2]["yearsOfExperience"] = "3"
    records[3]["salaryMax"] = "a lot"
    path = write_json_array(os.path.join(tmp_root, "raw", "b.json"), records)
    root = os.path.join(tmp_root, "lake-typed")
    pipeline.run_bronze(spark, None, os.path.dirname(path), root)
    bronze = read_layer(spark, root, "bronze", "vietnamworks")
    rows = {r.jobTitle: r for r in bronze.collect()}
    assert (rows["J1"].salaryMin, rows["J2"].yearsOfExperience, rows["J3"].salaryMax) == (1501, 3, None)
    assert rows["J3"]._bad_fields == ["salaryMax"] and rows["J0"]._bad_fields == []
    assert json.loads(rows["J2"].raw)["jobId"] == 2 and json.loads(rows["J2"].raw)["benefits"] == ["x"]
    assert [(r.check, r.failures) for r in raw_quality(bronze).collect()] == [("salaryMax", 1)]
    pipeline.run_silver(spark, root)
    assert read_layer(spark, root, "silver", "vietnamworks").count() == 4


def test_array_files_of_a_large_month(spark, monkeypatch, tmp_root):
    """A month of many orders is written as several arrays; no row or value is lost."""
    from jobstar.plans import catalog
    path = os.path.join(tmp_root, "orders.parquet")
    o = spark.read.parquet("/root/testdata/sf0.001/orders.parquet").where("o_orderdate < '1996-01-01'")
    month = F.when(F.col("o_orderkey") % 3 == 0, F.lit("1995-05-05")).when(F.col("o_orderkey") % 50 != 1, F.col("o_orderdate"))
    o.withColumn("o_orderdate", month.cast("timestamp")).write.parquet(path)
    whole = {r.o_orderkey: r[:-1] for r in catalog.q_bronze_array_files(spark, tmp_root).collect()}
    monkeypatch.setattr(catalog, "_ARRAY_RECORDS", 40)
    rows = catalog.q_bronze_array_files(spark, tmp_root).collect()
    assert len(rows) == len(whole) == o.count() and all(r[:-1] == whole[r.o_orderkey] for r in rows)
    hot = {r.n_files_of_month for r in rows if r.o_orderkey % 3 == 0}
    n = sum(k % 3 == 0 for k in whole)
    assert len(hot) == 1 and n / 40 <= hot.pop() <= n / 40 + 5


def test_raw_records_from_lines(spark, tmp_root):
    from jobstar.sources.readers import read_raw_records
    os.makedirs(os.path.join(tmp_root, "lines"))
    with open(os.path.join(tmp_root, "lines", "x.json"), "w") as f:
        f.write(json.dumps(posting_b(jobTitle="J")) + "\n\n{broken\n" + json.dumps({"jobTitle": 5}) + "\n")
    rows = read_raw_records(spark, os.path.join(tmp_root, "lines"), schemas.BRONZE_B, lines=True).collect()
    assert [r.jobTitle for r in rows] == ["J", None, "5"]
    assert [r._corrupt_record is None for r in rows] == [True, False, True]


def test_malformed_raw_kept_in_bronze_excluded_from_silver(spark, tmp_root):
    ra, rb = _fixtures(tmp_root)
    with open(os.path.join(ra, "broken.json"), "w") as f:
        f.write('[{"id": "9", "title": "x", ')                     # truncated file
    root = os.path.join(tmp_root, "lake-bad")
    pipeline.run_bronze(spark, ra, rb, root)
    bronze = read_layer(spark, root, "bronze", "topcv")
    assert bronze.filter(F.col("_corrupt_record").isNotNull()).count() == 1
    pipeline.run_silver(spark, root)
    assert read_layer(spark, root, "silver", "topcv").count() == 2   # as without the broken file
    from jobstar.plans.silver import silver_quality_a
    rep = {r.check: r.failures for r in silver_quality_a(bronze).collect()}
    assert rep["malformed"] == 1
