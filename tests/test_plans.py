"""Plan assertions: the physical plans we rely on at scale."""

from pyspark.sql import functions as F

from jobstar.operators.dedup import latest_per_key
from jobstar.operators.joins import lookup
from jobstar.operators.reports import top_n
from jobstar.plans.catalog import QUERIES
from tests.helpers import plan_text

SF = "/root/testdata/sf0.001"


def test_dedup_uses_group_limit(spark):
    o = spark.read.parquet(f"{SF}/orders.parquet")
    plan = plan_text(latest_per_key(o, ["o_custkey"], ["o_orderdate"]))
    assert "WindowGroupLimit" in plan


def test_parquet_pruning_and_pushdown(spark):
    o = spark.read.parquet(f"{SF}/orders.parquet")
    plan = plan_text(o.filter(F.col("o_orderstatus") == "F").select("o_orderkey"))
    assert "PushedFilters: [IsNotNull(o_orderstatus), EqualTo(o_orderstatus,F)]" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string>" in plan


def test_small_dimension_is_broadcast(spark):
    c = spark.read.parquet(f"{SF}/customer.parquet")
    n = spark.read.parquet(f"{SF}/nation.parquet")
    plan = plan_text(lookup(c, n, [("c_nationkey", "n_nationkey")], ["n_name"]))
    assert "BroadcastHashJoin" in plan


def test_top_n_is_take_ordered(spark):
    o = spark.read.parquet(f"{SF}/orders.parquet")
    assert "TakeOrderedAndProject" in plan_text(top_n(o, ["o_custkey"], 10))


def test_no_python_in_catalog_plans(spark):
    for name, fn in QUERIES.items():
        if name.startswith("roundtrip") or name in ("layered_write", "stream_landing"):
            continue
        plan = plan_text(fn(spark, SF))
        if name.startswith("board_") or name == "page_selected":  # pages whose elements nest: one parse per page
            assert "MapInArrow" in plan
            continue
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan, name


def test_runtime_broadcast_decided_by_aqe(spark):
    li = spark.read.parquet(f"{SF}/lineitem.parquet")
    dim = li.select("l_returnflag", "l_linestatus").dropDuplicates()   # a shuffle output
    out = lookup(li, dim.withColumn("flag_id", F.lit(1)), [("l_returnflag", "l_returnflag"),
                                                          ("l_linestatus", "l_linestatus")],
                 ["flag_id"])
    out.write.format("noop").mode("overwrite").save()
    plan = plan_text(out, mode="extended")
    assert "BroadcastHashJoin" in plan and "strategy=broadcast" not in plan   # Spark's own choice


def test_cluster_conf_scales_with_input():
    from jobstar.session import cluster_conf
    big = cluster_conf(100 * 1024 ** 4, total_cores=8000)
    small = cluster_conf(10 * 1024 ** 3, total_cores=8000)
    assert int(big["spark.sql.shuffle.partitions"]) > 100_000 > 16_000 == int(small["spark.sql.shuffle.partitions"])


def test_silver_tags_only_the_rows_that_stay(spark):
    from jobstar.plans.catalog import postings_bronze
    from jobstar.plans.silver import silver_board_a
    plan = plan_text(silver_board_a(postings_bronze(spark, SF)), mode="simple").split("Window [", 1)
    assert plan[0].count("Contains(") >= 60 and "Contains(" not in plan[1]


def test_company_report_tags_nothing(spark):
    assert "Contains(" not in plan_text(QUERIES["gold_top_companies"](spark, SF), mode="simple")


def test_building_queries_runs_nothing(spark):
    tracker = spark.sparkContext.statusTracker()
    for name, fn in QUERIES.items():
        if name.startswith(("roundtrip", "bronze", "gold_roundtrip")) or name in (
                "layered_write", "stream_landing", "gold_key_checks", "gold_snapshots", "array_blocks", "incremental_latest",
                "envelope_directory", "months_report", "sketch_report"):
            continue
        spark.sparkContext.setJobGroup(f"build-{name}", name)
        fn(spark, SF)
        jobs = [tracker.getJobInfo(j) for j in tracker.getJobIdsForGroup(f"build-{name}")]
        stages = [tracker.getStageInfo(i) for j in jobs if j for i in j.stageIds]
        # reading a Parquet schema is a job of one task; nothing else may run
        assert all(s is None or s.name.startswith("parquet at") for s in stages), name
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_key_checks_take_one_shuffle_per_table_scan(spark):
    from jobstar.operators.checks import key_checks
    c, o = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("customer", "orders"))
    plan = plan_text(key_checks({"customer": c, "orders": o}, {"customer": "c_custkey", "orders": "o_orderkey"},
                                [("orders", "customer", "o_custkey")]), mode="simple")
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("FileScan") == 2 and "Join" not in plan


def test_dated_report_scans_its_months(spark, tmp_root):
    from jobstar.operators.reports import dated_distribution
    from jobstar.operators.star import build_date_dimension
    from jobstar.sources.readers import read_layer
    from jobstar.sources.sinks import write_layer, write_months
    o = spark.read.parquet(f"{SF}/orders.parquet")
    write_months(o, tmp_root, "gold", "orders", "o_orderdate")
    stored = read_layer(spark, tmp_root, "gold", "orders", prefix="months_")
    write_layer(build_date_dimension(o, "o_orderdate"), tmp_root, "gold", "dim_date")
    report = dated_distribution(stored, read_layer(spark, tmp_root, "gold", "dim_date"), "Year = 1997 AND Month = 5", ["Day"],
                                date_col="o_orderdate")
    assert sum(r.n for r in report.collect()) == o.where("date_format(o_orderdate, 'yyyyMM') = '199705'").count() > 0
    assert "dynamicpruning" in plan_text(report, mode="simple")
    pruned = stored.where("in_month = 199705")
    assert "PartitionFilters: [isnotnull(in_month" in plan_text(pruned, mode="simple") and all("in_month=199705" in f for f in {
        r[0] for r in pruned.select(F.input_file_name()).distinct().collect()})
