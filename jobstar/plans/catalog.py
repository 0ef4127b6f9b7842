"""Driver-table queries: every operator of the pipeline applied to the
driver's tables, each paired with an equivalent DuckDB SQL oracle.

Each query reads whole tables (no sampling, no id subsets); where an
operator needs job-board text, the text is built from table columns with
the same expression in Spark and in SQL, so the work grows with the data.
Array results are shown joined (``array_join``) so both engines print the
same scalar.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from jobstar import schemas
from jobstar.functions import html as H
from jobstar.functions.arrays import (
    DISTRICT_PATTERN, city_district, clean_list, district_from_address, field_of_first, pick, project_field,
)
from jobstar.functions.dates import DEADLINE_LABEL, deadline_to_date, parse_iso_date
from jobstar.functions.keys import row_key, stable_key
from jobstar.functions.parse import (
    currency_to_vnd, decode_work_form, experience_years, headcount, salary_range, size_range,
    size_range_struct,
)
from jobstar.functions.selectors import Step, select
from jobstar.functions.tagging import SKILL_KEYWORDS, with_keyword_tags
from jobstar.operators.asof import to_base_currency
from jobstar.operators.board import board_bronze, board_cards, board_detail
from jobstar.operators.checks import fk_violations, key_checks, pk_violations
from jobstar.operators.conform import (
    required_filter, to_schema, union_sources, with_row_key, with_source,
)
from jobstar.operators.dedup import latest_per_key
from jobstar.operators.history import dimension_history, lookup_version
from jobstar.operators.joins import lookup
from jobstar.operators.pages import (
    cards, envelope_rows, extract_fields, links_indexed, merge_listing_detail, selected, split_head,
    with_defaults,
)
from jobstar.operators.reports import dated_distribution, distribution, top_n
from jobstar.operators.sketches import distinct_from_sketches, distinct_sketches
from jobstar.operators.star import (
    DimRef, build_bridge, build_date_dimension, build_dimension, build_fact, explode_items,
)
from jobstar.plans.gold import gold_tables, gold_view
from jobstar.plans.silver import silver_board_a, silver_board_b, silver_quality_a
from jobstar.session import materialize, scratch_path
from jobstar.sources import snapshots
from jobstar.sources.readers import read_envelopes, read_json_records, read_layer, read_raw_records
from jobstar.sources.sinks import land_bronze, load_warehouse, month_of, write_layer, write_months, write_tables
from jobstar.streaming.ingest import land_stream

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# ---------------------------------------------------------------- SQL helpers
def _sq(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _sql_measured(x: str) -> str:
    return f"coalesce(length(CAST({x} AS VARCHAR)) || ':' || CAST({x} AS VARCHAR), 'N')"


def sql_row_key(*parts: str, arrays: tuple[int, ...] = ()) -> str:
    """DuckDB text of ``functions.keys.row_key`` over SQL expressions."""
    items = []
    for i, p in enumerate(parts):
        if i in arrays:
            inner = f"coalesce(array_to_string(list_transform({p}, lambda x: {_sql_measured('x')}), ''), '')"
            items.append(f"coalesce(len({p}) || '[' || {inner} || ']', 'N')")
        else:
            items.append(_sql_measured(p))
    return f"md5({' || '.join(items)})"


def sql_key(*parts: str, arrays: tuple[int, ...] = ()) -> str:
    """DuckDB text of ``functions.keys.stable_key``."""
    return f"('0x' || substr({sql_row_key(*parts, arrays=arrays)}, 1, 15))::BIGINT"


def sql_html_text(x: str) -> str:
    out = f"regexp_replace({x}, '<[^>]*>', ' ', 'g')"
    for ent, ch in H.ENTITIES:
        out = f"replace({out}, {_sq(ent)}, {_sq(ch)})"
    return f"trim(regexp_replace({out}, '{H.SPACES}', ' ', 'g'))"


SQL_STRIPPED = f"regexp_replace(html, {_sq(H.NOISE_BLOCKS)}, ' ', 'g')"


def sql_element(h: str, tag: str) -> str:
    inner = f"regexp_extract({h}, '(?is)<{tag}\\b[^>]*>(.*?)</{tag}>', 1)"
    return f"nullif({sql_html_text(inner)}, '')"


SQL_VOCAB = "[" + ", ".join(_sq(k) for k in SKILL_KEYWORDS) + "]"

# ============================================================ flagship


@register("top_skills", f"""
WITH t AS (
  SELECT doc_id, unnest(list_filter({SQL_VOCAB}, lambda k: contains(lower(text), k))) AS tag
  FROM documents)
SELECT tag, count(DISTINCT doc_id) AS n_docs FROM t
GROUP BY tag ORDER BY n_docs DESC, tag ASC LIMIT 10
""")
def q_top_skills(spark, d):
    """C8 tags -> S3 explode -> G8 top skills by distinct documents."""
    docs = with_keyword_tags(table(spark, d, "documents").select("doc_id", "text"), "text", "tags")
    return top_n(explode_items(docs, ["doc_id"], "tags", "tag"), ["tag"], 10,
                 count_distinct="doc_id", out="n_docs")


@register("keyword_tags", f"""
SELECT doc_id, array_to_string(tags, ',') AS tags, CAST(len(tags) AS INTEGER) AS n_tags
FROM (SELECT doc_id, list_filter({SQL_VOCAB}, lambda k: contains(lower(text), k)) AS tags
      FROM documents)
""")
def q_keyword_tags(spark, d):
    """Vocabulary tags of every document, vocabulary order."""
    t = with_keyword_tags(table(spark, d, "documents").select("doc_id", "text"), "text", "tags")
    return t.select("doc_id", F.array_join("tags", ",").alias("tags"),
                    F.size("tags").alias("n_tags"))


# ============================================================ dedup
@register("dedup_latest", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC NULLS LAST,
         o_orderkey, o_orderstatus, o_totalprice, o_orderpriority) AS rn FROM orders)
WHERE rn = 1
""")
def q_dedup_latest(spark, d):
    """Latest order per customer, full tie-break."""
    return latest_per_key(table(spark, d, "orders"), ["o_custkey"], ["o_orderdate"])


@register("dedup_latest_pair", """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY l_partkey, l_suppkey ORDER BY l_shipdate DESC NULLS LAST,
         l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
         l_returnflag, l_linestatus) AS rn FROM lineitem)
WHERE rn = 1
""")
def q_dedup_latest_pair(spark, d):
    """Latest line per (part, supplier), composite raw key."""
    return latest_per_key(table(spark, d, "lineitem"), ["l_partkey", "l_suppkey"], ["l_shipdate"])


# ============================================================ dimensions
@register("dim_keyed", f"""
SELECT p_brand, p_type, {sql_key('p_brand', 'p_type')} AS brand_type_id
FROM (SELECT DISTINCT p_brand, p_type FROM part)
""")
def q_dim_keyed(spark, d):
    """G1 + stable key (replaces B27)."""
    return build_dimension(table(spark, d, "part"), {"p_brand": "p_brand", "p_type": "p_type"},
                           "brand_type_id")


@register("dim_date", """
SELECT DateID, CAST(day(DateID) AS INTEGER) AS Day, CAST(month(DateID) AS INTEGER) AS Month,
       CAST(quarter(DateID) AS INTEGER) AS Quarter, CAST(year(DateID) AS INTEGER) AS Year
FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS DateID FROM orders)
""")
def q_dim_date(spark, d):
    """G3/C13/B24/B25."""
    return build_date_dimension(table(spark, d, "orders"), "o_orderdate")


@register("dim_multi_array", f"""
SELECT p_brand, p_type, array_to_string(tokens, ' ') AS tokens,
       {sql_key('p_brand', 'p_type', 'tokens', arrays=(2,))} AS position_id
FROM (SELECT DISTINCT p_brand, p_type, string_split(p_name, ' ') AS tokens FROM part)
""")
def q_dim_multi_array(spark, d):
    """Distinct with an array column in the key (order-sensitive)."""
    p = table(spark, d, "part")
    dim = build_dimension(p, {"p_brand": "p_brand", "p_type": "p_type",
                              "tokens": F.split("p_name", " ")}, "position_id")
    return dim.withColumn("tokens", F.array_join("tokens", " "))


@register("key_edges", f"""
SELECT n, {sql_row_key('part')} AS part_key, {sql_row_key('items', arrays=(0,))} AS items_key,
       {sql_row_key('part', 'items', arrays=(1,))} AS both_key, {sql_key('items', arrays=(0,))} AS items_id
FROM (SELECT DISTINCT n, CASE n WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN 'N' WHEN 3 THEN '\\N' ELSE '1:a' END AS part,
        CASE n WHEN 0 THEN NULL WHEN 1 THEN CAST([] AS VARCHAR[]) WHEN 2 THEN [''] WHEN 3 THEN [NULL]
               WHEN 4 THEN ['\\N'] WHEN 5 THEN ['a, b'] WHEN 6 THEN ['a', 'b'] WHEN 7 THEN ['a', NULL]
               ELSE ['', p_brand] END AS items
      FROM (SELECT p_partkey % 9 AS n, p_brand FROM part))
""")
def q_key_edges(spark, d):
    """Keys of nulls, empty texts and empty arrays all differ."""
    n = F.col("n")
    none = F.lit(None).cast("string")
    part = F.when(n == 1, "").when(n == 2, "N").when(n == 3, "\\N").when(n > 3, "1:a")
    items = (F.when(n == 1, F.array().cast("array<string>")).when(n == 2, F.array(F.lit("")))
              .when(n == 3, F.array(none)).when(n == 4, F.array(F.lit("\\N"))).when(n == 5, F.array(F.lit("a, b")))
              .when(n == 6, F.array(F.lit("a"), F.lit("b"))).when(n == 7, F.array(F.lit("a"), none))
              .when(n == 8, F.array(F.lit(""), F.col("p_brand"))))
    x = (table(spark, d, "part").select((F.col("p_partkey") % 9).alias("n"), "p_brand")
         .select("n", part.alias("part"), items.alias("items")).dropDuplicates())
    return x.select("n", row_key(x, ["part"]).alias("part_key"), row_key(x, ["items"]).alias("items_key"),
                    row_key(x, ["part", "items"]).alias("both_key"), stable_key(x, ["items"]).alias("items_id"))


@register("dim_status", f"""
SELECT o_orderstatus, {sql_key('o_orderstatus')} AS status_id
FROM (SELECT DISTINCT o_orderstatus FROM orders)
""")
def q_dim_status(spark, d):
    """G4."""
    return build_dimension(table(spark, d, "orders"), {"o_orderstatus": "o_orderstatus"}, "status_id")


@register("dim_token", f"""
SELECT token, {sql_key('token')} AS token_id
FROM (SELECT DISTINCT trim(unnest(string_split(p_name, ' '))) AS token FROM part)
""")
def q_dim_token(spark, d):
    """Distinct trimmed items of exploded arrays."""
    toks = explode_items(table(spark, d, "part"), [], F.split("p_name", " "), "token")
    return build_dimension(toks, {"token": "token"}, "token_id")


# ============================================================ bridge
@register("bridge_explode", """
SELECT DISTINCT p_partkey, trim(unnest(string_split(p_name, ' '))) AS token FROM part
""")
def q_bridge_explode(spark, d):
    """S3 + B26 + G6 (items, not keys)."""
    return explode_items(table(spark, d, "part"), ["p_partkey"], F.split("p_name", " "),
                         "token").dropDuplicates()


@register("bridge_lookup", f"""
SELECT DISTINCT p_partkey, {sql_key('token')} AS token_id
FROM (SELECT p_partkey, trim(unnest(string_split(p_name, ' '))) AS token FROM part)
""")
def q_bridge_lookup(spark, d):
    """D5 + G6: item -> key through a join with the token dimension."""
    p = table(spark, d, "part").withColumn("tokens", F.split("p_name", " "))
    dim = build_dimension(explode_items(p, [], "tokens", "token"), {"token": "token"}, "token_id")
    return build_bridge(p, "p_partkey", "tokens", "token", "token_id", dim=dim)


@register("top_tokens", """
SELECT token, count(DISTINCT p_partkey) AS n_parts
FROM (SELECT p_partkey, trim(unnest(string_split(p_name, ' '))) AS token FROM part)
GROUP BY token ORDER BY n_parts DESC, token ASC LIMIT 10
""")
def q_top_tokens(spark, d):
    """G8 on part-name tokens."""
    toks = explode_items(table(spark, d, "part"), ["p_partkey"], F.split("p_name", " "), "token")
    return top_n(toks, ["token"], 10, count_distinct="p_partkey", out="n_parts")


# ============================================================ fact
_FACT_SQL = f"""
SELECT {sql_row_key('l.l_orderkey', 'l.l_linenumber')} AS line_id,
       {sql_key('p.p_brand', 'p.p_type')} AS brand_type_id,
       {sql_key('o.o_orderstatus')} AS status_id,
       {sql_key('l.l_returnflag', 'l.l_linestatus')} AS flag_id,
       CAST(o.o_orderdate AS DATE) AS DateID,
       l.l_quantity AS quantity, l.l_extendedprice AS extendedprice
FROM lineitem l
LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey
LEFT JOIN part p ON l.l_partkey = p.p_partkey
"""


def _fact(spark, d, method):
    li = table(spark, d, "lineitem")
    o = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_orderdate")
    p = table(spark, d, "part").select("p_partkey", "p_brand", "p_type")
    base = (li.join(o, li.l_orderkey == o.o_orderkey, "left")
              .join(p, li.l_partkey == p.p_partkey, "left")
              .withColumn("DateID", F.to_date("o_orderdate")))
    dims = [
        DimRef("brand_type_id", {"p_brand": "p_brand", "p_type": "p_type"}),
        DimRef("status_id", {"o_orderstatus": "o_orderstatus"}),
        DimRef("flag_id", {"l_returnflag": "l_returnflag", "l_linestatus": "l_linestatus"}),
    ]
    if method == "join":
        # each dimension from its own (narrow) source table, not from the
        # joined base, so the lineitem joins are not recomputed per dimension
        for dim, src in zip(dims, [p, o, li]):
            dim.table = build_dimension(src, dim.natural, dim.key_col)
    return build_fact(base, dims, {"DateID": "DateID", "quantity": "l_quantity",
                                   "extendedprice": "l_extendedprice"},
                      id_col="line_id", id_from=["l_orderkey", "l_linenumber"], method=method)


@register("fact_star", _FACT_SQL)
def q_fact_star(spark, d):
    """Fact with keys derived on the row (no dimension joins)."""
    return _fact(spark, d, "derive")


@register("fact_star_join", _FACT_SQL)
def q_fact_star_join(spark, d):
    """Same fact through null-safe full-key lookup joins."""
    return _fact(spark, d, "join")


# ============================================================ key checks
@register("pk_check", """
SELECT o_custkey, o_orderdate, count(*) AS n FROM orders
GROUP BY o_custkey, o_orderdate HAVING count(*) > 1
""")
def q_pk_check(spark, d):
    return pk_violations(table(spark, d, "orders"), ["o_custkey", "o_orderdate"])


@register("fk_check", """
SELECT l.* FROM lineitem l
WHERE l.l_partkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM part p WHERE p.p_partkey = l.l_partkey)
""")
def q_fk_check(spark, d):
    return fk_violations(table(spark, d, "lineitem"), table(spark, d, "part"),
                         [("l_partkey", "p_partkey")])


# ============================================================ reports
@register("active_customers", """
SELECT o_custkey, count(*) AS n_orders FROM orders
GROUP BY o_custkey ORDER BY n_orders DESC, o_custkey ASC LIMIT 10
""")
def q_active_customers(spark, d):
    return top_n(table(spark, d, "orders"), ["o_custkey"], 10, out="n_orders")


@register("distribution_month", """
SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, count(*) AS n_orders
FROM orders GROUP BY 1
""")
def q_distribution_month(spark, d):
    o = table(spark, d, "orders").withColumn("month", F.trunc(F.to_date("o_orderdate"), "month"))
    return distribution(o, ["month"], out="n_orders")


@register("distribution_status", """
SELECT o_orderstatus, o_orderpriority, count(*) AS n_orders FROM orders GROUP BY 1, 2
""")
def q_distribution_status(spark, d):
    return distribution(table(spark, d, "orders"), ["o_orderstatus", "o_orderpriority"], out="n_orders")


# ============================================================ union
@register("union_by_name", """
SELECT c_custkey AS party_key, c_name AS name, c_nationkey AS nationkey, c_acctbal AS acctbal,
       c_mktsegment AS segment, 'customer' AS source FROM customer
UNION ALL
SELECT s_suppkey, s_name, s_nationkey, s_acctbal, NULL, 'supplier' FROM supplier
""")
def q_union_by_name(spark, d):
    c = table(spark, d, "customer").select(
        F.col("c_custkey").alias("party_key"), F.col("c_name").alias("name"),
        F.col("c_nationkey").alias("nationkey"), F.col("c_acctbal").alias("acctbal"),
        F.col("c_mktsegment").alias("segment"))
    s = table(spark, d, "supplier").select(
        F.col("s_suppkey").alias("party_key"), F.col("s_name").alias("name"),
        F.col("s_acctbal").alias("acctbal"), F.col("s_nationkey").alias("nationkey"))
    return union_sources([with_source(c, "customer"), with_source(s, "supplier")], allow_missing=True)


# ============================================================ nested fields
@register("json_field", """
SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events
""")
def q_json_field(spark, d):
    """B19/B21 on JSON text: parse to a struct, then a field path."""
    e = table(spark, d, "events")
    return e.select("event_id", F.from_json("props", "k INT")["k"].alias("k"))


@register("struct_project", """
SELECT conv_id, turn, jf.parentName AS major_field,
       array_to_string(list_transform(jf.children, lambda x: x.name), ',') AS relation_fields,
       jf.children[1].name AS first_child
FROM (SELECT conv_id, turn,
             {'parentName': role,
              'children': [{'name': role}, {'name': CAST(turn AS VARCHAR)}]} AS jf
      FROM conversations)
""")
def q_struct_project(spark, d):
    """Nested struct path, array<struct> -> array<field>,
    first item's field."""
    c = table(spark, d, "conversations")
    jf = F.struct(F.col("role").alias("parentName"),
                  F.array(F.struct(F.col("role").alias("name")),
                          F.struct(F.col("turn").cast("string").alias("name"))).alias("children"))
    x = c.select("conv_id", "turn", jf.alias("jobFunction"))
    return x.select("conv_id", "turn", F.col("jobFunction.parentName").alias("major_field"),
                    F.array_join(project_field("jobFunction.children", "name"), ",").alias("relation_fields"),
                    field_of_first("jobFunction.children", "name").alias("first_child"))


@register("envelope_explode", """
SELECT conv_id, turn, role, CAST(length(text) AS INTEGER) AS n_chars,
       CAST(CASE WHEN conv_id % 3 = 0 THEN 0 ELSE max(turn) OVER (PARTITION BY conv_id, turn // 4) END AS BIGINT) AS nb_pages
FROM conversations WHERE conv_id % 5 <> 0
""")
def q_envelope_explode(spark, d):
    """Envelopes {data: [item, ...], meta: {nbPages}} -> rows + page
    count. Each envelope holds up to four turns; some lack ``data``, some ``meta``."""
    return _envelope_items(_envelopes(spark, d))


def _envelopes(spark, d) -> DataFrame:
    c = table(spark, d, "conversations")
    env = (c.groupBy("conv_id", F.expr("turn div 4").alias("page"))
            .agg(F.collect_list(F.struct("conv_id", "turn", "role", "text")).alias("data"), F.max("turn").alias("nb")))
    return env.select(
        F.when(F.col("conv_id") % 5 != 0, F.col("data")).alias("data"),
        F.when(F.col("conv_id") % 3 != 0, F.struct(F.col("nb").alias("nbPages"))).alias("meta"))


@register("envelope_directory", ORACLE["envelope_explode"])
def q_envelope_directory(spark, d):
    """The same envelopes written as files, an envelope per line, and read back as a directory."""
    env, path = _envelopes(spark, d), scratch_path(spark, "envelopes")
    env.write.json(path)
    return _envelope_items(read_envelopes(spark, path, env.schema, lines=True))


def _envelope_items(env: DataFrame) -> DataFrame:
    rows = envelope_rows(env)
    return rows.select("conv_id", "turn", "role", F.length("text").alias("n_chars"),
                       rows.nb_pages.cast("bigint").alias("nb_pages"))


# ============================================================ text parsers
_SALARY_TEXT_SQL = """CASE p_type
  WHEN 'LARGE' THEN 'Thỏa thuận'
  WHEN 'SMALL' THEN p_size || ' - ' || (p_size + 10) || ' triệu'
  WHEN 'MEDIUM' THEN 'Tới ' || p_size || ' triệu'
  WHEN 'PROMO' THEN 'Trên ' || p_size || ' triệu'
  WHEN 'ECONOMY' THEN p_size || '.5 - ' || (p_size + 5) || ' triệu'
  ELSE p_size || ',000 - ' || (p_size + 1) || ',000 USD' END"""


def _salary_text() -> Column:
    s = F.col("p_size").cast("string")
    return (F.when(F.col("p_type") == "LARGE", F.lit("Thỏa thuận"))
             .when(F.col("p_type") == "SMALL",
                   F.concat(s, F.lit(" - "), (F.col("p_size") + 10).cast("string"), F.lit(" triệu")))
             .when(F.col("p_type") == "MEDIUM", F.concat(F.lit("Tới "), s, F.lit(" triệu")))
             .when(F.col("p_type") == "PROMO", F.concat(F.lit("Trên "), s, F.lit(" triệu")))
             .when(F.col("p_type") == "ECONOMY",
                   F.concat(s, F.lit(".5 - "), (F.col("p_size") + 5).cast("string"), F.lit(" triệu")))
             .otherwise(F.concat(s, F.lit(",000 - "), (F.col("p_size") + 1).cast("string"),
                                 F.lit(",000 USD"))))


@register("salary_range", f"""
SELECT p_partkey, salary,
  CASE WHEN contains(s, 'thỏa thuận') THEN NULL
       WHEN regexp_matches(s, '\\d+') THEN TRY_CAST(regexp_extract(s, '(\\d+)', 1) AS BIGINT) * 1000000
  END AS min_salary,
  CASE WHEN contains(s, 'thỏa thuận') THEN NULL
       WHEN regexp_matches(s, '\\d+\\s*-\\s*(\\d+)')
       THEN TRY_CAST(regexp_extract(s, '\\d+\\s*-\\s*(\\d+)', 1) AS BIGINT) * 1000000
  END AS max_salary
FROM (SELECT p_partkey, salary, lower(salary) AS s
      FROM (SELECT p_partkey, {_SALARY_TEXT_SQL} AS salary FROM part))
""")
def q_salary_range(spark, d):
    """C1 reference rules."""
    p = table(spark, d, "part").select("p_partkey", _salary_text().alias("salary"))
    lo, hi = salary_range("salary")
    return p.select("p_partkey", "salary", lo.alias("min_salary"), hi.alias("max_salary"))


# Salary texts and what they mean: (text, min, max), with n = p_size and m = p_size + 5.
_SALARY_CASES = [
    ("Thỏa thuận", "NULL", "NULL"), ("thoả thuận", "NULL", "NULL"), ("Negotiable", "NULL", "NULL"),
    ("{n} - {m} triệu", "n * 1000000", "m * 1000000"), ("Tới {n} triệu", "NULL", "n * 1000000"),
    ("đến {n} triệu", "NULL", "n * 1000000"), ("Trên {n} triệu", "n * 1000000", "NULL"),
    ("{n}.5 - {m} triệu", "n * 1000000 + 500000", "m * 1000000"), ("{n},5 triệu", "n * 1000000 + 500000", "NULL"),
    ("{n},000 - {m},000 USD", "n * 24000000", "m * 24000000"), ("${n}00 - ${m}00", "n * 2400000", "m * 2400000"),
    ("{n}00 USD - {m}00 USD", "n * 2400000", "m * 2400000"), ("up to ${m}00", "NULL", "m * 2400000"),
    ("từ {n} đến {m} triệu", "n * 1000000", "m * 1000000"), ("{n}tr đến {m}tr", "n * 1000000", "m * 1000000"),
    ("{n},000,000 - {m},000,000 VND", "n * 1000000", "m * 1000000"), ("{n}.000.000.000 VND", "n * 1000000000", "NULL"),
    ("{n},000,000,000,000 VND", "n * 1000000000000", "NULL"), ("15,000,000 - 20,000,000 VND", "15000000", "20000000"),
    ("1,000,000,000 VND", "1000000000", "NULL"), ("$1000 - $2000", "24000000", "48000000"),
    ("1000 USD - 2000 USD", "24000000", "48000000"), ("từ 10 đến 15 triệu", "10000000", "15000000"),
    ("10tr đến 15tr", "10000000", "15000000"), ("{n} – {m}", "n * 1000000", "m * 1000000"),
    ("cạnh tranh", "NULL", "NULL"),
]


def _salary_case(i: int) -> str:
    values = [_sq(c[i]) if i == 0 else f"CAST({c[i]} AS BIGINT)" for c in _SALARY_CASES]
    return "CASE k " + " ".join(f"WHEN {k} THEN {v}" for k, v in enumerate(values)) + " END"


@register("salary_range_fixed", f"""
SELECT p_partkey, replace(replace({_salary_case(0)}, '{{n}}', CAST(n AS VARCHAR)), '{{m}}', CAST(m AS VARCHAR)) AS salary,
       {_salary_case(1)} AS min_salary, {_salary_case(2)} AS max_salary
FROM (SELECT p_partkey, p_partkey % {len(_SALARY_CASES)} AS k, CAST(p_size AS BIGINT) AS n,
             CAST(p_size AS BIGINT) + 5 AS m FROM part)
""")
def q_salary_range_fixed(spark, d):
    """C1 fixed rules against a table of expected values."""
    text = F.get(F.array(*[F.lit(c[0]) for c in _SALARY_CASES]), (F.col("p_partkey") % len(_SALARY_CASES)).cast("int"))
    text = F.replace(F.replace(text, F.lit("{n}"), F.col("p_size").cast("string")), F.lit("{m}"),
                     (F.col("p_size") + 5).cast("string"))
    p = table(spark, d, "part").select("p_partkey", text.alias("salary"))
    lo, hi = salary_range("salary", mode="fixed")
    return p.select("p_partkey", "salary", lo.alias("min_salary"), hi.alias("max_salary"))


@register("experience_years", """
SELECT c_custkey, yoe_text,
  CASE WHEN contains(s, 'không yêu cầu') THEN 0.0
       WHEN contains(s, 'trên') THEN 5.5
       WHEN regexp_matches(s, '\\d+') THEN CAST(TRY_CAST(regexp_extract(s, '(\\d+)', 1) AS INTEGER) AS DOUBLE)
  END AS yoe
FROM (SELECT c_custkey, yoe_text, trim(lower(yoe_text)) AS s FROM (
  SELECT c_custkey, CASE c_mktsegment
    WHEN 'AUTOMOBILE' THEN 'Không yêu cầu kinh nghiệm'
    WHEN 'BUILDING' THEN 'Trên ' || c_nationkey || ' năm'
    WHEN 'FURNITURE' THEN ' ' || c_nationkey || ' năm '
    WHEN 'HOUSEHOLD' THEN 'Dưới 1 năm'
    ELSE 'Thương lượng' END AS yoe_text FROM customer))
""")
def q_experience_years(spark, d):
    """C2."""
    c = table(spark, d, "customer")
    n = F.col("c_nationkey").cast("string")
    seg = F.col("c_mktsegment")
    txt = (F.when(seg == "AUTOMOBILE", F.lit("Không yêu cầu kinh nghiệm"))
            .when(seg == "BUILDING", F.concat(F.lit("Trên "), n, F.lit(" năm")))
            .when(seg == "FURNITURE", F.concat(F.lit(" "), n, F.lit(" năm ")))
            .when(seg == "HOUSEHOLD", F.lit("Dưới 1 năm"))
            .otherwise(F.lit("Thương lượng")))
    x = c.select("c_custkey", txt.alias("yoe_text"))
    return x.select("c_custkey", "yoe_text", experience_years("yoe_text").alias("yoe"))


_SIZE_A_SQL = """CASE p_type
  WHEN 'LARGE' THEN (p_size * 100) || '+ nhân viên'
  WHEN 'SMALL' THEN p_size || ' nhân viên'
  WHEN 'MEDIUM' THEN p_size || '-' || (p_size * 20) || ' nhân viên'
  WHEN 'PROMO' THEN p_size || ' - ' || (p_size * 20)
  WHEN 'ECONOMY' THEN p_size || ',000+ Nhân Viên'
  ELSE p_size || '.000-' || (p_size + 1) || '.000' END"""


def _size_a_text() -> Column:
    s, t = F.col("p_size"), F.col("p_type")
    ss = s.cast("string")
    return (F.when(t == "LARGE", F.concat((s * 100).cast("string"), F.lit("+ nhân viên")))
             .when(t == "SMALL", F.concat(ss, F.lit(" nhân viên")))
             .when(t == "MEDIUM", F.concat(ss, F.lit("-"), (s * 20).cast("string"), F.lit(" nhân viên")))
             .when(t == "PROMO", F.concat(ss, F.lit(" - "), (s * 20).cast("string")))
             .when(t == "ECONOMY", F.concat(ss, F.lit(",000+ Nhân Viên")))
             .otherwise(F.concat(ss, F.lit(".000-"), (s + 1).cast("string"), F.lit(".000"))))


@register("size_range", f"""
SELECT p_partkey, size_text, size_min,
  CASE WHEN contains(s, '+') THEN size_min WHEN NOT contains(s, '-') THEN size_min
       ELSE TRY_CAST(regexp_extract(s, '-(\\d+)', 1) AS INTEGER) END AS size_max,
  size_min_fixed,
  CASE WHEN contains(s2, '+') THEN NULL WHEN NOT contains(s2, '-') THEN size_min_fixed
       ELSE TRY_CAST(regexp_extract(s2, '-\\s*(\\d+)', 1) AS INTEGER) END AS size_max_fixed
FROM (SELECT *, TRY_CAST(regexp_extract(s, '(\\d+)', 1) AS INTEGER) AS size_min,
             TRY_CAST(regexp_extract(s2, '(\\d+)', 1) AS INTEGER) AS size_min_fixed
      FROM (SELECT *, regexp_replace(s, '(\\d)[,.](\\d)', '\\1\\2', 'g') AS s2
            FROM (SELECT p_partkey, size_text, trim(lower(size_text)) AS s
                  FROM (SELECT p_partkey, {_SIZE_A_SQL} AS size_text FROM part))))
""")
def q_size_range(spark, d):
    """C3a, reference and fixed rules side by side."""
    p = table(spark, d, "part").select("p_partkey", _size_a_text().alias("size_text"))
    lo, hi = size_range("size_text")
    flo, fhi = size_range("size_text", mode="fixed")
    return p.select("p_partkey", "size_text", lo.alias("size_min"), hi.alias("size_max"),
                    flo.alias("size_min_fixed"), fhi.alias("size_max_fixed"))


_SIZE_B_SQL = """CASE p_type
  WHEN 'LARGE' THEN (p_size * 10) || '-' || (p_size * 50)
  WHEN 'SMALL' THEN (p_size * 100) || '+'
  WHEN 'MEDIUM' THEN p_size || ',000+'
  WHEN 'PROMO' THEN p_size || ' - ' || (p_size * 3)
  WHEN 'ECONOMY' THEN (p_size * 5) || '-'
  ELSE 'n/a' END"""


def _size_b_text() -> Column:
    s, t = F.col("p_size"), F.col("p_type")
    ss = s.cast("string")
    return (F.when(t == "LARGE", F.concat((s * 10).cast("string"), F.lit("-"), (s * 50).cast("string")))
             .when(t == "SMALL", F.concat((s * 100).cast("string"), F.lit("+")))
             .when(t == "MEDIUM", F.concat(ss, F.lit(",000+")))
             .when(t == "PROMO", F.concat(ss, F.lit(" - "), (s * 3).cast("string")))
             .when(t == "ECONOMY", F.concat((s * 5).cast("string"), F.lit("-")))
             .otherwise(F.lit("n/a")))


@register("size_range_struct", f"""
SELECT p_partkey, size_text,
  CASE WHEN ok THEN p0 END AS size_min, CASE WHEN ok THEN p1 END AS size_max
FROM (SELECT *, (size_text <> '' AND p0 IS NOT NULL AND (p1_raw IS NULL OR p1 IS NOT NULL)) AS ok
  FROM (SELECT *, TRY_CAST(trim(parts[1]) AS INTEGER) AS p0, parts[2] AS p1_raw,
               TRY_CAST(trim(parts[2]) AS INTEGER) AS p1
    FROM (SELECT p_partkey, size_text,
                 string_split(trim(regexp_replace(size_text, '[,+]', '', 'g')), '-') AS parts
          FROM (SELECT p_partkey, {_SIZE_B_SQL} AS size_text FROM part))))
""")
def q_size_range_struct(spark, d):
    """C3b/U2 without a UDF."""
    p = table(spark, d, "part").select("p_partkey", _size_b_text().alias("size_text"))
    st = size_range_struct("size_text")
    return p.select("p_partkey", "size_text", st["min"].alias("size_min"), st["max"].alias("size_max"))


_CCY_SQL = "CASE n.n_regionkey WHEN 0 THEN 'USD' WHEN 1 THEN 'VND' WHEN 2 THEN 'EUR' ELSE 'VND' END"


@register("currency_norm", f"""
SELECT c_custkey, currency, amount,
  CASE WHEN currency = 'USD' AND amount IS NOT NULL AND amount <> 0 THEN amount * 24000
       WHEN currency = 'VND' AND amount IS NOT NULL AND amount <> 0 THEN amount END AS amount_vnd
FROM (SELECT c.c_custkey, {_CCY_SQL} AS currency, CAST(floor(c.c_acctbal) AS BIGINT) AS amount
      FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey)
""")
def q_currency_norm(spark, d):
    """C4 after a lookup join to nation (size-checked broadcast)."""
    c = table(spark, d, "customer")
    x = lookup(c, table(spark, d, "nation"), [("c_nationkey", "n_nationkey")], ["n_regionkey"],
               null_safe=False)
    r = F.col("n_regionkey")
    ccy = (F.when(r == 0, "USD").when(r == 1, "VND").when(r == 2, "EUR").otherwise("VND"))
    x = x.select("c_custkey", ccy.alias("currency"), F.floor("c_acctbal").alias("amount"))
    return x.withColumn("amount_vnd", currency_to_vnd("amount", "currency"))


@register("decode_status", """
SELECT o_orderkey,
  CASE WHEN code = 1 THEN 'Toàn thời gian' ELSE 'Bán thời gian' END AS work_form,
  CASE WHEN code IS NULL THEN NULL WHEN code = 1 THEN 'Toàn thời gian' ELSE 'Bán thời gian' END
    AS work_form_strict
FROM (SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 END AS code FROM orders)
""")
def q_decode_status(spark, d):
    """C5 (reference: null -> part time; strict: null stays null)."""
    o = table(spark, d, "orders")
    code = F.when(F.col("o_orderstatus") == "F", 1).when(F.col("o_orderstatus") == "O", 2)
    x = o.select("o_orderkey", code.alias("code"))
    return x.select("o_orderkey", decode_work_form("code").alias("work_form"),
                    decode_work_form("code", null_is_part_time=False).alias("work_form_strict"))


@register("date_from_label", f"""
SELECT o_orderkey, deadline_text,
  CAST(try_strptime(replace(deadline_text, {_sq(DEADLINE_LABEL)}, ''), '%d/%m/%Y') AS DATE) AS deadline_date,
  approved_on, TRY_CAST(split_part(approved_on, 'T', 1) AS DATE) AS approved_date
FROM (SELECT o_orderkey, {_sq(DEADLINE_LABEL)} || strftime(o_orderdate, '%d/%m/%Y') AS deadline_text,
             strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') || '+07:00' AS approved_on FROM orders)
""")
def q_date_from_label(spark, d):
    """C10 (B7 + B8) and B9 on text rendered from order dates."""
    o = table(spark, d, "orders").select(
        "o_orderkey",
        F.concat(F.lit(DEADLINE_LABEL), F.date_format("o_orderdate", "dd/MM/yyyy")).alias("deadline_text"),
        F.concat(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+07:00")).alias("approved_on"))
    return o.select("o_orderkey", "deadline_text", deadline_to_date("deadline_text").alias("deadline_date"),
                    "approved_on", parse_iso_date("approved_on").alias("approved_date"))


@register("headcount", """
SELECT p_partkey, txt, TRY_CAST(replace(txt, ' người', '') AS INTEGER) AS num_of_recruit
FROM (SELECT p_partkey, CASE WHEN p_type = 'PROMO' THEN 'Nhiều' ELSE p_size || ' người' END AS txt
      FROM part)
""")
def q_headcount(spark, d):
    """C11 (B7 + B10)."""
    p = table(spark, d, "part")
    txt = F.when(F.col("p_type") == "PROMO", F.lit("Nhiều")).otherwise(
        F.concat(F.col("p_size").cast("string"), F.lit(" người")))
    x = p.select("p_partkey", txt.alias("txt"))
    return x.select("p_partkey", "txt", headcount("txt").alias("num_of_recruit"))


# ============================================================ arrays
@register("array_pick", """
SELECT p_partkey, a[1] AS city, a[2] AS district, a[3] AS third
FROM (SELECT p_partkey, string_split(p_name, ' ') AS a FROM part)
""")
def q_array_pick(spark, d):
    p = table(spark, d, "part").select("p_partkey", F.split("p_name", " ").alias("a"))
    city, district = city_district("a")
    return p.select("p_partkey", city.alias("city"), district.alias("district"), pick("a", 3).alias("third"))


@register("array_clean", """
SELECT p_partkey, array_to_string(c, ',') AS items, CAST(len(c) AS INTEGER) AS n_items
FROM (SELECT p_partkey,
             list_filter(list_concat(string_split(p_name, ' '), [p_type]), lambda x: x IS DISTINCT FROM 'hot') AS c
      FROM part)
""")
def q_array_clean(spark, d):
    p = table(spark, d, "part")
    arr = F.concat(F.split("p_name", " "), F.array("p_type"))
    x = p.select("p_partkey", clean_list(arr, "hot").alias("c"))
    return x.select("p_partkey", F.array_join("c", ",").alias("items"), F.size("c").alias("n_items"))


_ADDR_SQL = """CASE c.c_mktsegment
  WHEN 'AUTOMOBILE' THEN c.c_custkey || ' Lê Lợi, Quận Tân Bình, HCM'
  WHEN 'BUILDING' THEN 'Q.' || n.n_name
  WHEN 'FURNITURE' THEN 'Quận ' || c.c_nationkey || ', HCM'
  WHEN 'HOUSEHOLD' THEN 'QUẬN Tân Phú, ' || n.n_name
  ELSE c.c_custkey || ' abc' END"""


@register("address_district", f"""
SELECT c_custkey, address,
       nullif(trim(regexp_extract(address, '(?i)(Quận|Q\\.)\\s*([^\\.,\\d]+)', 2)), '') AS district
FROM (SELECT c.c_custkey, {_ADDR_SQL} AS address
      FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey)
""")
def q_address_district(spark, d):
    """C7 (fixed rule; the reference rule differs between Java and RE2 on
    upper-case Vietnamese, so only the fixed rule is compared)."""
    return (_addresses(spark, d)
            .select("c_custkey", "address", district_from_address("address", mode="fixed").alias("district")))


def _addresses(spark, d) -> DataFrame:
    c = table(spark, d, "customer")
    x = lookup(c, table(spark, d, "nation"), [("c_nationkey", "n_nationkey")], ["n_name"],
               null_safe=False)
    seg = F.col("c_mktsegment")
    ck = F.col("c_custkey").cast("string")
    addr = (F.when(seg == "AUTOMOBILE", F.concat(ck, F.lit(" Lê Lợi, Quận Tân Bình, HCM")))
             .when(seg == "BUILDING", F.concat(F.lit("Q."), F.col("n_name")))
             .when(seg == "FURNITURE", F.concat(F.lit("Quận "), F.col("c_nationkey").cast("string"), F.lit(", HCM")))
             .when(seg == "HOUSEHOLD", F.concat(F.lit("QUẬN Tân Phú, "), F.col("n_name")))
             .otherwise(F.concat(ck, F.lit(" abc"))))
    return x.select("c_custkey", addr.alias("address"))


@register("address_district_reference", f"""
SELECT c_custkey, address, regexp_extract(address, {_sq(DISTRICT_PATTERN)}, 2) AS district
FROM (SELECT c.c_custkey, replace({_ADDR_SQL}, 'QUẬN', 'Quận') AS address
      FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey)
""")
def q_address_district_reference(spark, d):
    """C7, the reference rule, on texts that write "Quận" so: Java and RE2 take capitals outside ASCII differently."""
    y = _addresses(spark, d).withColumn("address", F.replace("address", F.lit("QUẬN"), F.lit("Quận")))
    return y.withColumn("district", district_from_address("address"))


@register("landing_key", f"""
SELECT page_id, url, {sql_row_key('url')} AS id FROM pages
""")
def q_landing_key(spark, d):
    """Rerun-stable landing id from the page link."""
    return with_row_key(table(spark, d, "pages").select("page_id", "url"), ["url"], "id")


# ============================================================ filter
@register("required_filter", """
SELECT doc_id, lang, source FROM (
  SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN '' WHEN doc_id % 7 = 1 THEN '  ' ELSE text END AS text,
         CASE WHEN doc_id % 11 = 0 THEN NULL ELSE lang END AS lang, source FROM documents)
WHERE text IS NOT NULL AND text <> '' AND lang IS NOT NULL AND lang <> '' AND source IS NOT NULL AND source <> ''
""")
def q_required_filter(spark, d):
    """B28/B29 with empty and null fields planted; a text of blanks stays, as in the source."""
    i = F.col("doc_id")
    docs = table(spark, d, "documents").select(
        "doc_id", F.when(i % 7 == 0, "").when(i % 7 == 1, "  ").otherwise(F.col("text")).alias("text"),
        F.when(i % 11 != 0, F.col("lang")).alias("lang"), "source")
    return required_filter(docs, ["text", "lang", "source"]).select("doc_id", "lang", "source")


# ============================================================ pages
def _page_fields(pages: DataFrame) -> DataFrame:
    h = H.strip_noise(F.col("html"))
    links = H.attr_values(h, "a", "href")
    return extract_fields(pages, "html", {
        "lang": F.nullif(F.regexp_extract("html", r'(?is)<html\b[^>]*\blang="([^"]*)"', 1), F.lit("")),
        "title": H.element_text(h, "title"),
        "h1": H.element_text(h, "h1"),
        "footer": H.element_text(h, "footer"),
        "n_links": F.size(links),
        "links": F.array_join(links, " "),
    })


_PAGE_FIELDS_SQL = f"""
SELECT page_id, url,
  nullif(regexp_extract(html, '(?is)<html\\b[^>]*\\blang="([^"]*)"', 1), '') AS lang,
  {sql_element('h', 'title')} AS title, {sql_element('h', 'h1')} AS h1,
  {sql_element('h', 'footer')} AS footer,
  CAST(len(regexp_extract_all(h, '(?is)<a\\b[^>]*\\bhref="([^"]*)"', 1)) AS INTEGER) AS n_links,
  array_to_string(regexp_extract_all(h, '(?is)<a\\b[^>]*\\bhref="([^"]*)"', 1), ' ') AS links
FROM (SELECT page_id, url, html, {SQL_STRIPPED} AS h FROM pages)
"""


@register("page_fields", _PAGE_FIELDS_SQL)
def q_page_fields(spark, d):
    """Typed fields and link list per stored page."""
    return _page_fields(table(spark, d, "pages"))


_CARD_BLOCK = r"(?is)<li\b[^>]*>(.*?)</li>"
_CARD_FIELDS = {"href": r'(?is)<a\b[^>]*\bhref="([^"]*)"', "label": r"(?is)<a\b[^>]*>(.*?)</a>"}


@register("page_cards", f"""
SELECT page_id, card_idx, href, label FROM (
  SELECT page_id, card_idx,
    nullif({sql_html_text("regexp_extract(blk, " + _sq(_CARD_FIELDS['href']) + ", 1)")}, '') AS href,
    nullif({sql_html_text("regexp_extract(blk, " + _sq(_CARD_FIELDS['label']) + ", 1)")}, '') AS label
  FROM (SELECT page_id, unnest(b) AS blk, CAST(generate_subscripts(b, 1) - 1 AS INTEGER) AS card_idx
        FROM (SELECT page_id, regexp_extract_all({SQL_STRIPPED}, {_sq(_CARD_BLOCK)}, 1) AS b FROM pages)))
WHERE href IS NOT NULL AND label IS NOT NULL
""")
def q_page_cards(spark, d):
    """Listing blocks -> one row per card; incomplete cards skipped."""
    return cards(table(spark, d, "pages"), "page_id", "html", _CARD_BLOCK, _CARD_FIELDS)


@register("page_links_indexed", f"""
SELECT page_id, idx, href FROM (
  SELECT page_id, idx, regexp_extract(attrs, '(?i)\\bhref="([^"]*)"', 1) AS href
  FROM (SELECT page_id, unnest(t) AS attrs, CAST(generate_subscripts(t, 1) - 1 AS INTEGER) AS idx
        FROM (SELECT page_id, regexp_extract_all({SQL_STRIPPED}, '(?is)<a\\b([^>]*)>', 1) AS t FROM pages)))
WHERE href <> ''
""")
def q_page_links_indexed(spark, d):
    """X7."""
    return links_indexed(table(spark, d, "pages"), "page_id", "html")


_ARTICLE = r"(?is)<article\b[^>]*>(.*?)</article>"
_SQL_PARAS = ("list_filter(list_transform(list_slice(regexp_split_to_array("
              f"regexp_extract({SQL_STRIPPED}, {_sq(_ARTICLE)}, 1), '(?i)<p\\b[^>]*>'), 2, 1073741824), "
              f"lambda x: {sql_html_text('x')}), lambda t: t <> '')")


def _paragraphs() -> Column:
    return H.paragraphs(F.regexp_extract(H.strip_noise(F.col("html")), _ARTICLE, 1))


@register("page_positions", f"""
SELECT page_id, CAST(len(p) AS INTEGER) AS n_paragraphs, p[1] AS p0, p[3] AS p2, p[4] AS p3, p[5] AS p4
FROM (SELECT page_id, {_SQL_PARAS} AS p FROM pages)
""")
def q_page_positions(spark, d):
    """Positional items 0, 2, 3, 4 of the paragraph list."""
    x = table(spark, d, "pages").select("page_id", _paragraphs().alias("p"))
    return x.select("page_id", F.size("p").alias("n_paragraphs"),
                    *H.positional("p", [0, 2, 3, 4], ["p0", "p2", "p3", "p4"]))


_SQL_BOLD = (f"list_transform(regexp_extract_all({SQL_STRIPPED}, '(?is)<b\\b[^>]*>(.*?)</b>', 1), "
             f"lambda x: {sql_html_text('x')})")


@register("page_list_split", f"""
SELECT page_id, CAST(len(head) AS INTEGER) AS n_head, CAST(len(bold) AS INTEGER) AS n_tail, head[1] AS head_first,
       head[len(head)] AS head_last
FROM (SELECT page_id, bold, p[1:greatest(len(p) - len(bold), 0)] AS head
      FROM (SELECT page_id, {_SQL_PARAS} AS p, {_SQL_BOLD} AS bold FROM pages))
""")
def q_page_list_split(spark, d):
    """Head of a list whose tail items are a known second list."""
    x = table(spark, d, "pages").select(
        "page_id", _paragraphs().alias("p"),
        H.elements_text(H.strip_noise(F.col("html")), "b").alias("bold"))
    y = x.select("page_id", "bold", split_head("p", "bold").alias("head"))
    return y.select("page_id", F.size("head").alias("n_head"), F.size("bold").alias("n_tail"),
                    F.get("head", 0).alias("head_first"),
                    F.try_element_at("head", F.lit(-1)).alias("head_last"))


@register("count_text", """
SELECT page_id, CAST(n AS INTEGER) AS n FROM (SELECT page_id, CAST(length(html) AS BIGINT) * 1000 + page_id % 1000 AS n FROM pages)
""")
def q_count_text(spark, d):
    """The count in a listing page's heading, digits grouped by dots."""
    count = F.replace(F.format_number(F.length("html").cast("long") * 1000 + F.col("page_id") % 1000, 0), F.lit(","), F.lit("."))
    head = F.concat(F.lit('<h1 class="job-found">Tìm thấy '), count, F.lit(" việc làm</h1>"))
    p = table(spark, d, "pages").select("page_id", F.concat(head, "html").alias("html"))
    found = H.element_text(H.strip_noise(F.col("html")), "h1")
    return p.select("page_id", H.count_from_text(found).alias("n"))


# Listing and detail pages of the scraped board, rendered from ``part``: nested
# elements, entities, single quotes, sections and lists that are missing, cards that
# lack a field, and links without a detail page.
def _joined(*parts) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def _board_pages(spark, d) -> DataFrame:
    k, size = F.col("p_partkey"), F.col("p_size").cast("string")
    value = '<div class="job-detail__info--section-content-value">'

    def section(there: Column, *text) -> Column:
        inner = F.when(there, _joined(value, *text, "</div>")).otherwise("")
        return _joined("<div class='s'><div class='icon'></div><div class='c'><div>x</div>", inner, "</div></div>")

    def box(there: Column, *text) -> Column:
        return F.when(there, _joined(*text)).otherwise("")

    general = '<div class="box-general-group-info-value">'
    always = F.lit(True)
    detail = _joined(
        '<html><head><script>var a = "<div class=job-tags>";</script></head><body>',
        '<div class="job-detail__info--sections">', section(k % 5 != 0, size, " &#8211; triệu &amp; hơn"),
        section(always, "\n  ", F.col("p_brand"), "  "), section(k % 7 != 0, size, " năm"), "</div>",
        '<div class="job-detail__info--deadline">Hạn nộp hồ sơ: 01/02/2025</div>',
        "<section><h3>Mô tả công việc</h3><p>skip</p><div><div>", F.col("p_name"), "</div><div>a &lt; b &eacute;<br/>c</div></div><div>not</div></section>",
        box(k % 3 != 0, "<section><h3>Yêu cầu ứng viên</h3><div><ul><li>", F.col("p_type"), "<li>", size, "</ul></div></section>"),
        "<section><h3>Địa điểm làm việc</h3><div>", F.col("p_brand"), "</div></section>",
        "<div><div>Quy mô</div><div class='x company-value'>", size, "-", size, "0 nhân viên</div></div>",
        '<div class="w company-field"><div>Lĩnh vực</div><div class="company-value">', F.col("p_type"), "</div></div>",
        '<div class="job-tags-x"><span>no</span></div>', box(k % 4 != 0, '<div class="job-tags"><span><b>', F.col("p_type"), "</b></span> <span>IT</span></div>"),
        '<div class="box-general-content">', general, "Nhân viên</div>", general, "y</div>", general, size, " người</div>",
        box(k % 6 != 0, general, "Toàn thời gian</div>", general, "Nam</div>"), "</div>",
        '<div class="box-category-tags"><a>', F.col("p_brand"), "</a><a>Data</a></div>",
        box(k % 4 != 1, '<div class="box-category"><div class="box-category-tags"><span><a>Hà Nội</a></span><span><a>', F.col("p_brand"), "</a></span></div></div>"),
        "</body></html>")
    card = _joined(
        '<div class="box-header"><div><h3 class="t"><a data-href="no" href=\'https://x/', k.cast("string"), "?a=1&amp;b=2'><span>", F.col("p_name"),
        "</span></a></h3>", box(k % 9 != 0, '<a class="company">Cty &quot;', F.col("p_brand"), "&quot;</a>"),
        '<label class="deadline">', size, ' ngày</label><div class="label-content"><label class="address">Hà Nội</label>',
        '<label class="time">Còn ', size, " ngày</label></div></div></div>")
    # one row group here: spread before the wide pages are made, as pages of many files would be
    part = table(spark, d, "part").repartition(spark.sparkContext.defaultParallelism, "p_partkey")
    return part.select("p_partkey", "p_size", detail.alias("detail"), card.alias("card"),
                       _joined("https://x/", k.cast("string"), "?a=1&b=2").alias("href"))


_BOARD_SQL = """
SELECT p_partkey, 'https://x/' || p_partkey || '?a=1&b=2' AS href,
  CASE WHEN p_partkey % 5 <> 0 THEN p_size || ' – triệu & hơn' END AS salary, p_brand AS city,
  CASE WHEN p_partkey % 7 <> 0 THEN p_size || ' năm' END AS yoe, 'Hạn nộp hồ sơ: 01/02/2025' AS deadline_submit,
  p_name || ' a < b é c' AS description, CASE WHEN p_partkey % 3 <> 0 THEN p_type || ' ' || p_size END AS requirements,
  p_brand AS work_address, p_size || '-' || p_size || '0 nhân viên' AS company_size, p_type AS major_field,
  'Nhân viên' AS level, p_size || ' người' AS num_of_recruit,
  CASE WHEN p_partkey % 6 <> 0 THEN 'Toàn thời gian' END AS work_form, CASE WHEN p_partkey % 6 <> 0 THEN 'Nam' END AS gender_require,
  CASE WHEN p_partkey % 4 <> 0 THEN p_type || ',IT' ELSE '' END AS main_industry,
  p_brand || ',Data' || CASE WHEN p_partkey % 4 <> 1 THEN ',Hà Nội,' || p_brand ELSE '' END AS skills,
  CASE WHEN p_partkey % 4 <> 1 THEN 'Hà Nội,' || p_brand ELSE '' END AS area, p_brand || ',Data' AS relation_fields
FROM part"""
_CARDS_SQL = """
SELECT (p_partkey // 8) AS page, CAST(row_number() OVER (PARTITION BY p_partkey // 8 ORDER BY p_partkey) - 1 AS INTEGER) AS card_idx,
  'https://x/' || p_partkey || '?a=1&b=2' AS href, p_name AS title, 'Cty "' || p_brand || '"' AS company_name,
  p_size || ' ngày' AS update_time, 'Hà Nội' AS city, 'Còn ' || p_size || ' ngày' AS remain_time
FROM part WHERE p_partkey % 9 <> 0"""
_BOARD_LISTS = ("main_industry", "skills", "area", "relation_fields")


def _flat_lists(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.array_join(c, ",") for c in _BOARD_LISTS})


def _listing_cards(pages: DataFrame) -> DataFrame:
    listing = (pages.groupBy(F.expr("p_partkey div 8").alias("page"))
               .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("p_partkey", "card"))), lambda x: x["card"]), "\n").alias("html")))
    return board_cards(listing, ["page"])


@register("board_detail", _BOARD_SQL)
def q_board_detail(spark, d):
    """X1-X4 on detail pages with nested elements and missing parts."""
    return _flat_lists(board_detail(_board_pages(spark, d), ["p_partkey", "href"], "detail"))


@register("board_cards", _CARDS_SQL)
def q_board_cards(spark, d):
    """Listing pages of eight cards; a card without a company is skipped."""
    return _listing_cards(_board_pages(spark, d))


@register("board_bronze", f"""
SELECT {sql_row_key('d.href')} AS id, c.title, c.company_name, d.salary, d.city, d.yoe, d.deadline_submit, d.main_industry,
  d.description, d.requirements, d.work_address, d.company_size, d.major_field, d.level, d.num_of_recruit, d.work_form,
  d.gender_require, d.relation_fields, d.skills, d.area, c.update_time, c.remain_time
FROM ({_CARDS_SQL}) c JOIN ({_BOARD_SQL} WHERE p_partkey % 10 <> 4) d ON c.href = d.href
""")
def q_board_bronze(spark, d):
    """Listing cards merged with their detail pages into bronze A records; one detail page in ten is missing."""
    pages = _board_pages(spark, d)
    detail = board_detail(pages.where("p_partkey % 10 <> 4"), ["href"], "detail")
    return _flat_lists(board_bronze(_listing_cards(pages), detail))


@register("page_defaults", f"""
SELECT page_id, coalesce({sql_element('h', 'h2')}, 'n/a') AS subtitle,
       coalesce({sql_element('h', 'title')}, 'n/a') AS title
FROM (SELECT page_id, {SQL_STRIPPED} AS h FROM pages)
""")
def q_page_defaults(spark, d):
    """Absent fields get defaults."""
    p = table(spark, d, "pages")
    h = H.strip_noise(F.col("html"))
    x = p.select("page_id", H.element_text(h, "h2").alias("subtitle"),
                 H.element_text(h, "title").alias("title"))
    return with_defaults(x, {"subtitle": "n/a", "title": "n/a"})


@register("page_merge", f"""
SELECT l.page_id, l.url, d.title, d.h1, d.n_links
FROM pages l JOIN ({_PAGE_FIELDS_SQL}) d ON l.url = d.url
WHERE d.title IS NOT NULL
""")
def q_page_merge(spark, d):
    """Listing links merged with their detail rows (inner)."""
    pages = table(spark, d, "pages")
    listing = pages.select("page_id", "url")
    detail = (_page_fields(pages).filter(F.col("title").isNotNull())
              .select("url", "title", "h1", "n_links"))
    return merge_listing_detail(listing, detail, ["url"])


# ============================================================ sources and sinks
@register("roundtrip_parquet", "SELECT * FROM customer")
def q_roundtrip_parquet(spark, d):
    """Land non-empty sources as layered Parquet (an empty one
    is skipped), then scan the landed dataset."""
    root = scratch_path(spark, "layers")
    c = table(spark, d, "customer")
    land_bronze({"customer": c, "nothing": c.filter(F.lit(False))}, root)
    return read_layer(spark, root, "bronze", "customer")


@register("roundtrip_json", "SELECT * FROM orders")
def q_roundtrip_json(spark, d):
    """A1/A2: JSON records read back with an explicit schema."""
    o = table(spark, d, "orders")
    path = scratch_path(spark, "json")
    o.write.mode("overwrite").json(path)
    return read_json_records(spark, path, o.schema, multiline=False)


_RAW_ORDERS = StructType([StructField(n, t) for n, t in (
    ("o_orderkey", LongType()), ("o_custkey", LongType()), ("o_totalprice", DoubleType()),
    ("o_orderpriority", StringType()), ("o_shippriority", LongType()))])
_ARRAY_RECORDS = 200_000  # of an array file on average: some 26 MB, read by one task


def order_array_files(spark: SparkSession, d: str) -> str:
    """Folder with JSON array files of the orders of each month, under ``orders``."""
    o = table(spark, d, "orders")
    k = F.col("o_orderkey")
    price = F.when(k % 10 == 3, F.lit('"n/a"')).otherwise(F.to_json(F.struct(F.col("o_totalprice").alias("v"))).substr(
        F.lit(6), F.length(F.to_json(F.struct(F.col("o_totalprice").alias("v")))) - 6))
    ship = F.when(k % 6 == 1, F.lit("{}")).otherwise(F.concat((k % 5 * 2).cast("string"), F.lit(".75")))
    record = F.concat(F.lit('{"o_orderkey":'), k.cast("string"), F.lit(',"o_custkey":'), F.col("o_custkey").cast("string"),
                      F.lit(',"o_totalprice":'), price, F.lit(',"o_orderpriority":"'), F.col("o_orderpriority"),
                      F.lit('","o_shippriority":'), ship, F.lit(',"status":"'), F.col("o_orderstatus"), F.lit('"}'))
    month = F.date_format("o_orderdate", "yyyy-MM").alias("month")
    parts = (o.select(month).groupBy(F.col("month").alias("_m"))
             .agg(F.ceil(F.count(F.lit(1)) / _ARRAY_RECORDS).alias("n_parts")))
    files = (o.select(month, k.alias("k"), record.alias("r")).join(parts, F.col("month").eqNullSafe(F.col("_m")))
              .groupBy("month", F.expr("pmod(xxhash64(k), n_parts)").alias("part"))
              .agg(F.concat(F.lit("["), F.array_join(F.collect_list("r"), ","), F.lit("]")).alias("value")))
    root = scratch_path(spark, "raw")
    files.write.partitionBy("month", "part").text(f"{root}/orders")
    return root


@register("bronze_array_files", """
SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 10 = 3 THEN NULL ELSE o_totalprice END AS o_totalprice,
       o_orderpriority, CASE WHEN o_orderkey % 6 <> 1 THEN CAST(2 * (o_orderkey % 5) + 1 AS BIGINT) END AS o_shippriority,
       CASE WHEN o_orderkey % 10 = 3 AND o_orderkey % 6 = 1 THEN 'o_totalprice,o_shippriority'
            WHEN o_orderkey % 10 = 3 THEN 'o_totalprice' WHEN o_orderkey % 6 = 1 THEN 'o_shippriority' ELSE '' END AS bad_fields,
       o_orderstatus AS raw_status, CAST(1 AS BIGINT) AS n_files_of_month
FROM orders
""")
def q_bronze_array_files(spark, d):
    """A1/A2/A3: JSON array files per order month, one for every
    ``_ARRAY_RECORDS`` orders begun, with values that do not fit their type,
    landed record by record. Only those values are null, and the raw record
    keeps fields that no column reads."""
    root = order_array_files(spark, d)
    land_bronze({"orders": read_raw_records(spark, f"{root}/orders", _RAW_ORDERS)}, root)
    bronze = read_layer(spark, root, "bronze", "orders")
    per_month = (bronze.select(F.regexp_extract("source_file", "month=([0-9-]+)", 1).alias("m"), "source_file").distinct()
                 .groupBy("m").agg(F.count(F.lit(1)).alias("n_files_of_month")))
    rows = bronze.withColumn("m", F.regexp_extract("source_file", "month=([0-9-]+)", 1)).join(per_month, "m")
    return rows.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority", "o_shippriority",
                       F.array_join("_bad_fields", ",").alias("bad_fields"),
                       F.get_json_object("raw", "$.status").alias("raw_status"), "n_files_of_month")


@register("array_blocks", """
SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 10 = 3 THEN NULL ELSE o_totalprice END AS o_totalprice,
       o_orderpriority, CASE WHEN o_orderkey % 6 <> 1 THEN CAST(2 * (o_orderkey % 5) + 1 AS BIGINT) END AS o_shippriority,
       o_orderstatus AS raw_status, strftime(o_orderdate, '%Y-%m') AS month
FROM orders
""")
def q_array_blocks(spark, d):
    """JSON array files cut into blocks that many tasks read, each record on its own."""
    rows = read_raw_records(spark, f"{order_array_files(spark, d)}/orders", _RAW_ORDERS, split=True)
    return rows.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority", "o_shippriority",
                       F.get_json_object("raw", "$.status").alias("raw_status"),
                       F.regexp_extract("source_file", "month=([0-9-]+)", 1).alias("month"))


@register("incremental_latest", ORACLE["dedup_latest"])
def q_incremental_latest(spark, d):
    """W1/W3 by instalments: orders come as files in three instalments; each time only the new files are
    read and folded into the kept table. Every instalment is asked for twice, the second time there is nothing new."""
    o = table(spark, d, "orders")
    src, root, ckpt = (scratch_path(spark, n) for n in ("instalments", "kept", "fold-ckpt"))
    for i in range(3):
        o.where(F.pmod("o_orderkey", F.lit(3)) == i).write.mode("append").parquet(src)
        for _ in range(2):
            snapshots.fold_new_files(spark, src, ckpt, root, "orders", ["o_custkey"], ["o_orderdate"], buckets=8)
    return snapshots.read_snapshot(spark, root)["orders"].select(*o.columns)


@register("asof_rates", """
WITH rates AS (
  SELECT l_returnflag AS currency, CAST(date_trunc('month', l_shipdate) AS DATE) + 14 AS rate_date, count(*) AS rate
  FROM lineitem GROUP BY ALL),
f AS (SELECT l_orderkey, l_linenumber, l_returnflag AS currency, CAST(l_shipdate AS DATE) AS day,
             CAST(floor(l_extendedprice) AS BIGINT) AS amount FROM lineitem)
SELECT l_orderkey, l_linenumber, f.currency, day, amount,
       CASE WHEN amount <> 0 THEN amount * CASE WHEN f.currency = 'R' THEN 1 ELSE rate END END AS amount_base
FROM f ASOF LEFT JOIN rates r ON f.currency = r.currency AND f.day >= r.rate_date
""")
def q_asof_rates(spark, d):
    """C4 with a dated rate table: each line's amount by the rate in force on its day (as-of join; half of all
    lines have one currency, ``R`` is the base)."""
    li = table(spark, d, "lineitem")
    month = F.date_add(F.trunc("l_shipdate", "month"), 14)
    rates = li.groupBy(F.col("l_returnflag").alias("currency"), month.alias("rate_date")).agg(F.count(F.lit(1)).alias("rate"))
    f = li.select("l_orderkey", "l_linenumber", F.col("l_returnflag").alias("currency"), F.to_date("l_shipdate").alias("day"),
                  F.floor("l_extendedprice").alias("amount"))
    return to_base_currency(f, "amount", "currency", "day", rates, base="R", out="amount_base")


@register("dim_history", f"""
WITH per AS (SELECT o_custkey, CAST(o_orderdate AS DATE) AS valid_from, max(o_orderpriority) AS priority FROM orders GROUP BY ALL),
c AS (SELECT *, lag(priority) OVER w AS before, row_number() OVER w AS n FROM per WINDOW w AS (PARTITION BY o_custkey ORDER BY valid_from))
SELECT o_custkey, priority, valid_from, lead(valid_from) OVER (PARTITION BY o_custkey ORDER BY valid_from) AS valid_to,
       {sql_key('o_custkey', 'valid_from')} AS version_id
FROM c WHERE n = 1 OR priority IS DISTINCT FROM before
""")
def q_dim_history(spark, d):
    """G1 with history: a customer's versions, told from the priority of their orders over time."""
    return dimension_history(_customer_priorities(spark, d), ["o_custkey"], ["priority"], "day", "version_id")


def _customer_priorities(spark, d) -> DataFrame:
    return table(spark, d, "orders").select("o_custkey", F.to_date("o_orderdate").alias("day"), F.col("o_orderpriority").alias("priority"))


@register("fact_versions", f"""
WITH h AS ({ORACLE["dim_history"]}),
f AS (SELECT l_orderkey, l_linenumber, o_custkey, CAST(l_shipdate AS DATE) AS day FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
SELECT l_orderkey, l_linenumber, f.o_custkey, day, h.version_id, h.priority
FROM f ASOF LEFT JOIN h ON f.o_custkey = h.o_custkey AND f.day >= h.valid_from
""")
def q_fact_versions(spark, d):
    """G1/D1 with history: every line on the version of its customer that held on its ship date."""
    h = dimension_history(_customer_priorities(spark, d), ["o_custkey"], ["priority"], "day", "version_id")
    f = table(spark, d, "lineitem").join(table(spark, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    f = f.select("l_orderkey", "l_linenumber", "o_custkey", F.to_date("l_shipdate").alias("day"))
    return lookup_version(f, h, [("o_custkey", "o_custkey")], "day", ["version_id", "priority"])


@register("months_report", """
SELECT CAST(year(o_orderdate) AS INTEGER) AS "Year", CAST(month(o_orderdate) AS INTEGER) AS "Month", o_orderstatus,
       count(*) AS n_orders, CAST(sum(CASE WHEN year(o_orderdate) = 1997 THEN 2 ELSE 1 END * CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS cents
FROM orders WHERE quarter(o_orderdate) = 2 GROUP BY ALL
""")
def q_months_report(spark, d):
    """Orders stored by month, the months of 1997 written again with other amounts, then a report on the second
    quarters, which reads their months only."""
    root = scratch_path(spark, "months")
    o = table(spark, d, "orders").withColumn("cents", F.round(F.col("o_totalprice") * 100).cast("bigint"))
    write_months(o, root, "gold", "orders", "o_orderdate")
    write_months(o.where("year(o_orderdate) = 1997").withColumn("cents", 2 * F.col("cents")), root, "gold", "orders", "o_orderdate")
    stored = read_layer(spark, root, "gold", "orders", prefix="months_")
    write_layer(build_date_dimension(stored, "o_orderdate"), root, "gold", "dim_date")
    return dated_distribution(stored, read_layer(spark, root, "gold", "dim_date"), "Quarter = 2", ["Year", "Month", "o_orderstatus"],
                              {"n_orders": F.count(F.lit(1)), "cents": F.sum("cents")}, date_col="o_orderdate")


@register("sketch_report", """
SELECT l_returnflag, count(DISTINCT l_orderkey) AS n_orders, true AS within_3_percent FROM lineitem GROUP BY l_returnflag
""")
def q_sketch_report(spark, d):
    """G10 by stored sketches: orders per return flag, added up from a sketch per flag and month, beside the exact count."""
    li, root = table(spark, d, "lineitem"), scratch_path(spark, "sketches")
    write_layer(distinct_sketches(li.withColumn("month", month_of("l_shipdate")), ["l_returnflag", "month"], "l_orderkey"), root, "gold", "sketches")
    n = distinct_from_sketches(read_layer(spark, root, "gold", "sketches"), ["l_returnflag"], "estimate")
    exact = distribution(li, ["l_returnflag"], "l_orderkey", out="n_orders")
    return exact.join(n, "l_returnflag").select("l_returnflag", "n_orders", (F.abs(F.col("estimate") - F.col("n_orders"))
                                                                             <= 0.03 * F.col("n_orders")).alias("within_3_percent"))


@register("page_selected", """
SELECT c_custkey, CAST(i AS INTEGER) AS row_idx, CASE i WHEN 0 THEN '/c/' || c_custkey || '?a=1&b=2' ELSE '/n/' || c_nationkey || '/' END AS href,
       CASE i WHEN 0 THEN c_name || ' – é' ELSE c_mktsegment || ' > x' END AS label
FROM customer, (VALUES (0), (1)) t(i)
""")
def q_page_selected(spark, d):
    """X2/X5/X7 by selectors: links with either quote or none, character references, ``data-href`` and hidden ones beside them."""
    ck, nk = F.col("c_custkey").cast("string"), F.col("c_nationkey").cast("string")
    html = _joined('<nav><ul><li><a data-href="no" href=\'/c/', ck, "?a=1&amp;b=2'>", F.col("c_name"),
                   " &#8211; &eacute;</a><li class='it em'><div><A HREF=/n/", nk, "/ title='>'><b>", F.col("c_mktsegment"),
                   "</b> &gt; x<!-- </a> --></A></div></ul><script>'<li><a href=s>'</script><p><a href=/p>outside</a></nav>")
    pages = table(spark, d, "customer").select("c_custkey", html.alias("html"))
    rows = selected(pages, {"href": select(Step("a"), attr="href"), "label": select(Step("a"))}, ["c_custkey"], each=(Step("li"),))
    return rows.select("c_custkey", "row_idx", F.col("href")[0].alias("href"), F.col("label")[0].alias("label"))


@register("roundtrip_table", "SELECT * FROM supplier")
def q_roundtrip_table(spark, d):
    """Create-or-replace a warehouse table, then read it."""
    s = table(spark, d, "supplier")
    name = "jobstar_supplier_copy"
    load_warehouse(spark, {name: s}, path_root=scratch_path(spark, "warehouse"))
    return spark.table(name)


@register("layered_write", "SELECT * FROM nation")
def q_layered_write(spark, d):
    """A7 with a prefix: write then scan one layer path."""
    root = scratch_path(spark, "layers")
    write_layer(table(spark, d, "nation"), root, "gold", "nation", prefix="v1_")
    return read_layer(spark, root, "gold", "nation", prefix="v1_")


# ============================================================ the pipeline itself (E2 + E3)
# Board-A bronze rows derived from the whole ``documents`` table: every
# document is a posting whose requirements and description are its full
# text. Silver, the fact and the bridge then run unchanged.
_BRONZE_A_SQL = f"""
SELECT CAST(doc_id AS VARCHAR) AS id,
  CASE lang WHEN 'en' THEN ' Data Engineer ' WHEN 'fr' THEN 'Ingénieur Données '
            WHEN 'de' THEN 'DATEN Ingenieur ' ELSE 'Ingeniero de Datos ' END || ((doc_id // 20) % 25) AS title,
  ' ' || source || ' ' AS company_name,
  CASE WHEN n_chars < 500 THEN 'Thỏa thuận'
       WHEN n_chars < 2000 THEN (n_chars // 100) || ' - ' || (n_chars // 50) || ' triệu'
       ELSE 'Tới ' || (n_chars // 100) || ' triệu' END AS salary,
  CASE WHEN lang = 'es' THEN 'Thương lượng' WHEN n_chars < 1000 THEN 'Không yêu cầu kinh nghiệm'
       WHEN n_chars < 5000 THEN (n_chars // 1000) || ' năm' ELSE 'Trên 5 năm' END AS yoe,
  CASE WHEN lang = 'fr' AND n_chars < 1000
       THEN strftime(DATE '2024-01-01' + CAST(doc_id AS INTEGER), '%Y-%m-%d')
       ELSE {_sq(DEADLINE_LABEL)} || strftime(DATE '2024-01-01' + CAST(doc_id AS INTEGER), '%d/%m/%Y')
  END AS deadline_submit,
  text AS description, text AS requirements,
  (n_chars // 10) || '-' || (n_chars // 5) || ' nhân viên' AS company_size,
  lang AS major_field, 'Nhân viên' AS level,
  CASE WHEN lang = 'de' THEN 'Nhiều' ELSE length(source) || ' người' END AS num_of_recruit,
  CASE WHEN doc_id % 4 <> 3 THEN 'Toàn thời gian' END AS work_form,
  ['Việc làm IT', lang, source] AS relation_fields, ['Hà Nội', source] AS area
FROM documents"""


def postings_bronze(spark, d) -> DataFrame:
    """Board-A bronze rows derived from ``documents`` (same rules as the SQL)."""
    docs = table(spark, d, "documents")
    n, lang, src = F.col("n_chars"), F.col("lang"), F.col("source")

    def div(k):
        return F.expr(f"n_chars div {k}").cast("string")

    title = F.concat(F.when(lang == "en", " Data Engineer ").when(lang == "fr", "Ingénieur Données ")
                      .when(lang == "de", "DATEN Ingenieur ").otherwise("Ingeniero de Datos "),
                     F.expr("(doc_id div 20) % 25").cast("string"))
    salary = (F.when(n < 500, F.lit("Thỏa thuận"))
               .when(n < 2000, F.concat(div(100), F.lit(" - "), div(50), F.lit(" triệu")))
               .otherwise(F.concat(F.lit("Tới "), div(100), F.lit(" triệu"))))
    # a few deterministic dirty values, so the quality report has work to do
    yoe = (F.when(lang == "es", F.lit("Thương lượng"))
            .when(n < 1000, F.lit("Không yêu cầu kinh nghiệm"))
            .when(n < 5000, F.concat(div(1000), F.lit(" năm"))).otherwise(F.lit("Trên 5 năm")))
    day = F.date_add(F.lit("2024-01-01").cast("date"), F.col("doc_id").cast("int"))
    deadline = (F.when((lang == "fr") & (n < 1000), F.date_format(day, "yyyy-MM-dd"))
                 .otherwise(F.concat(F.lit(DEADLINE_LABEL), F.date_format(day, "dd/MM/yyyy"))))
    recruits = F.when(lang == "de", F.lit("Nhiều")).otherwise(
        F.concat(F.length(src).cast("string"), F.lit(" người")))
    bronze = docs.select(
        F.col("doc_id").cast("string").alias("id"), title.alias("title"),
        F.concat(F.lit(" "), src, F.lit(" ")).alias("company_name"), salary.alias("salary"),
        yoe.alias("yoe"), deadline.alias("deadline_submit"),
        F.col("text").alias("description"), F.col("text").alias("requirements"),
        F.concat(div(10), F.lit("-"), div(5), F.lit(" nhân viên")).alias("company_size"),
        lang.alias("major_field"), F.lit("Nhân viên").alias("level"),
        recruits.alias("num_of_recruit"),
        F.when(F.col("doc_id") % 4 != 3, "Toàn thời gian").alias("work_form"),
        F.array(F.lit("Việc làm IT"), lang, src).alias("relation_fields"),
        F.array(F.lit("Hà Nội"), src).alias("area"))
    return to_schema(bronze, schemas.BRONZE_A, allow_missing=True)


_SILVER_A_SQL = f"""
WITH bronze AS ({_BRONZE_A_SQL}),
s AS (
  SELECT id, trim(lower(title)) AS job_position, trim(company_name) AS company_name,
    CASE WHEN contains(y, 'không yêu cầu') THEN 0.0 WHEN contains(y, 'trên') THEN 5.5
         WHEN regexp_matches(y, '\\d+') THEN CAST(TRY_CAST(regexp_extract(y, '(\\d+)', 1) AS INTEGER) AS DOUBLE)
    END AS yoe,
    CAST(try_strptime(replace(deadline_submit, {_sq(DEADLINE_LABEL)}, ''), '%d/%m/%Y') AS DATE) AS job_posting_date,
    CASE WHEN contains(sal, 'thỏa thuận') THEN NULL
         WHEN regexp_matches(sal, '\\d+') THEN TRY_CAST(regexp_extract(sal, '(\\d+)', 1) AS BIGINT) * 1000000
    END AS min_salary,
    CASE WHEN contains(sal, 'thỏa thuận') THEN NULL
         WHEN regexp_matches(sal, '\\d+\\s*-\\s*(\\d+)')
         THEN TRY_CAST(regexp_extract(sal, '\\d+\\s*-\\s*(\\d+)', 1) AS BIGINT) * 1000000
    END AS max_salary,
    TRY_CAST(regexp_extract(sz, '(\\d+)', 1) AS INTEGER) AS company_size_min,
    CASE WHEN contains(sz, '+') OR NOT contains(sz, '-') THEN TRY_CAST(regexp_extract(sz, '(\\d+)', 1) AS INTEGER)
         ELSE TRY_CAST(regexp_extract(sz, '-(\\d+)', 1) AS INTEGER) END AS company_size_max,
    major_field, level,
    CAST(TRY_CAST(replace(num_of_recruit, ' người', '') AS INTEGER) AS BIGINT) AS num_of_recruit,
    work_form,
    list_filter(relation_fields, lambda x: x IS DISTINCT FROM 'Việc làm IT') AS relation_fields,
    list_filter({SQL_VOCAB}, lambda k: contains(lower(requirements), k)) AS skills_extracted,
    area[1] AS city, area[2] AS district, 'topcv' AS source, requirements, description
  FROM (SELECT *, trim(lower(yoe)) AS y, lower(salary) AS sal, trim(lower(company_size)) AS sz FROM bronze)),
f AS (SELECT * FROM s WHERE job_position IS NOT NULL AND job_position <> ''
        AND company_name IS NOT NULL AND company_name <> ''
        AND requirements IS NOT NULL AND requirements <> ''
        AND description IS NOT NULL AND description <> ''),
silver AS (
  SELECT * EXCLUDE (rn, id, requirements, description) FROM (
    SELECT *, row_number() OVER (PARTITION BY job_position, company_name
      ORDER BY job_posting_date DESC NULLS LAST, id) AS rn FROM f)
  WHERE rn = 1)"""


@register("silver_postings", _SILVER_A_SQL + """
SELECT * REPLACE (array_to_string(relation_fields, ',') AS relation_fields,
                  array_to_string(skills_extracted, ',') AS skills_extracted)
FROM silver
""")
def q_silver_postings(spark, d):
    """E2 on document-derived postings: C1-C3, C6, C8, C10-C12, B28, B3, W1."""
    s = silver_board_a(postings_bronze(spark, d))
    return s.withColumns({"relation_fields": F.array_join("relation_fields", ","),
                          "skills_extracted": F.array_join("skills_extracted", ",")})


_VIEW_SQL = _SILVER_A_SQL + f""",
view AS (SELECT * REPLACE (coalesce(work_form, '') AS work_form),
                {sql_row_key('company_name', 'job_position', 'job_posting_date')} AS JobPostingID,
                job_posting_date AS DateID FROM silver)"""


@register("gold_fact_postings", _VIEW_SQL + f"""
SELECT JobPostingID, {sql_key('company_name', 'major_field')} AS CompanyID,
       {sql_key('job_position', 'level', 'relation_fields', arrays=(2,))} AS JobPositionID,
       DateID, {sql_key('work_form')} AS WorkFormID, min_salary AS MinSalary,
       max_salary AS MaxSalary, yoe AS YOE, num_of_recruit AS NumOfRecruit
FROM view
""")
def q_gold_fact_postings(spark, d):
    """E3 fact_job (D6, G7) over the silver postings."""
    return gold_tables(gold_view([silver_board_a(postings_bronze(spark, d))]))["fact_job"]


@register("gold_bridge_postings", _VIEW_SQL + f"""
SELECT DISTINCT JobPostingID, {sql_key('SkillName')} AS SkillID
FROM (SELECT JobPostingID, trim(unnest(skills_extracted)) AS SkillName FROM view)
""")
def q_gold_bridge_postings(spark, d):
    """E3 fact_jobskill (S3, G5, G6) over the silver postings."""
    return gold_tables(gold_view([silver_board_a(postings_bronze(spark, d))]))["fact_jobskill"]


# Board-B (API) bronze rows derived from ``orders`` joined with ``customer``:
# nested structs and arrays of structs, as the API returns them.
_BRONZE_B_SQL = """
SELECT 'Analyst ' || o.o_orderpriority AS jobTitle, c.c_name AS companyName,
  CAST(c.c_nationkey AS BIGINT) AS yearsOfExperience,
  strftime(o.o_orderdate, '%Y-%m-%dT%H:%M:%S') || '+07:00' AS approvedOn,
  CAST(floor(o.o_totalprice / 1000) AS BIGINT) AS salaryMin,
  CAST(floor(o.o_totalprice / 500) AS BIGINT) AS salaryMax,
  CASE o.o_orderstatus WHEN 'F' THEN 'USD' WHEN 'O' THEN 'VND' ELSE 'EUR' END AS salaryCurrency,
  CASE c.c_mktsegment WHEN 'AUTOMOBILE' THEN '100-499' WHEN 'BUILDING' THEN '1,000+'
       WHEN 'FURNITURE' THEN '500-' WHEN 'HOUSEHOLD' THEN '25 - 99'
       ELSE CAST(c.c_nationkey AS VARCHAR) END AS companySize,
  {'parentName': c.c_mktsegment,
   'children': [{'name': o.o_orderstatus}, {'name': o.o_orderpriority}]} AS jobFunction,
  'Nhân viên' AS jobLevelVI, CAST(c.c_nationkey AS BIGINT) AS numberOfRecruits,
  CASE o.o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 END AS typeWorkingId,
  CASE WHEN o.o_orderstatus = 'P' THEN []
       ELSE [{'cityNameVI': 'Hồ Chí Minh',
              'address': CASE c.c_mktsegment WHEN 'MACHINERY' THEN 'Quận 1, HCM'
                              ELSE c.c_custkey || ' Lê Lợi, Quận Tân Bình, HCM' END}] END AS workingLocations,
  [{'skillName': ' ' || c.c_mktsegment}, {'skillName': o.o_orderpriority}] AS skills
FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey"""


def api_bronze(spark, d) -> DataFrame:
    """Board-B bronze rows derived from ``orders`` and ``customer``."""
    o = table(spark, d, "orders")
    c = table(spark, d, "customer")
    x = o.join(c, o.o_custkey == c.c_custkey, "left")
    st, seg = F.col("o_orderstatus"), F.col("c_mktsegment")
    size = (F.when(seg == "AUTOMOBILE", "100-499").when(seg == "BUILDING", "1,000+")
             .when(seg == "FURNITURE", "500-").when(seg == "HOUSEHOLD", "25 - 99")
             .otherwise(F.col("c_nationkey").cast("string")))
    address = F.when(seg == "MACHINERY", F.lit("Quận 1, HCM")).otherwise(
        F.concat(F.col("c_custkey").cast("string"), F.lit(" Lê Lợi, Quận Tân Bình, HCM")))
    loc = F.struct(F.lit("Hồ Chí Minh").alias("cityNameVI"), address.alias("address"))
    bronze = x.select(
        F.concat(F.lit("Analyst "), F.col("o_orderpriority")).alias("jobTitle"),
        F.col("c_name").alias("companyName"),
        F.col("c_nationkey").cast("bigint").alias("yearsOfExperience"),
        F.concat(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+07:00")).alias("approvedOn"),
        F.floor(F.col("o_totalprice") / 1000).alias("salaryMin"),
        F.floor(F.col("o_totalprice") / 500).alias("salaryMax"),
        F.when(st == "F", "USD").when(st == "O", "VND").otherwise("EUR").alias("salaryCurrency"),
        size.alias("companySize"),
        F.struct(seg.alias("parentName"),
                 F.array(F.struct(st.alias("name")), F.struct(F.col("o_orderpriority").alias("name")))
                 .alias("children")).alias("jobFunction"),
        F.lit("Nhân viên").alias("jobLevelVI"),
        F.col("c_nationkey").cast("bigint").alias("numberOfRecruits"),
        F.when(st == "F", 1).when(st == "O", 2).alias("typeWorkingId"),
        F.when(st == "P", F.array().cast("array<struct<cityNameVI:string,address:string>>"))
         .otherwise(F.array(loc)).alias("workingLocations"),
        F.array(F.struct(F.concat(F.lit(" "), seg).alias("skillName")),
                F.struct(F.col("o_orderpriority").alias("skillName"))).alias("skills"))
    return to_schema(bronze, schemas.BRONZE_B)


_SILVER_B_SQL = f"""
WITH bronze_b AS ({_BRONZE_B_SQL}),
sb AS (
  SELECT jobTitle AS job_position, companyName AS company_name,
    CAST(yearsOfExperience AS DOUBLE) AS yoe,
    TRY_CAST(split_part(approvedOn, 'T', 1) AS DATE) AS job_posting_date,
    CASE WHEN salaryCurrency = 'USD' AND salaryMin IS NOT NULL AND salaryMin <> 0 THEN salaryMin * 24000
         WHEN salaryCurrency = 'VND' AND salaryMin IS NOT NULL AND salaryMin <> 0 THEN salaryMin END AS min_salary,
    CASE WHEN salaryCurrency = 'USD' AND salaryMax IS NOT NULL AND salaryMax <> 0 THEN salaryMax * 24000
         WHEN salaryCurrency = 'VND' AND salaryMax IS NOT NULL AND salaryMax <> 0 THEN salaryMax END AS max_salary,
    CASE WHEN ok THEN p0 END AS company_size_min, CASE WHEN ok THEN p1 END AS company_size_max,
    jobFunction.parentName AS major_field, jobLevelVI AS level, numberOfRecruits AS num_of_recruit,
    CASE WHEN typeWorkingId = 1 THEN 'Toàn thời gian' ELSE 'Bán thời gian' END AS work_form,
    list_transform(jobFunction.children, lambda x: x.name) AS relation_fields,
    list_transform(skills, lambda x: x.skillName) AS skills_extracted,
    workingLocations[1].cityNameVI AS city,
    regexp_extract(workingLocations[1].address, '(?i)(Quận|Q\\.)\\s*([^\\.,\\d]+)', 2) AS district,
    'vietnamworks' AS source
  FROM (SELECT *, (companySize <> '' AND p0 IS NOT NULL AND (p1_raw IS NULL OR p1 IS NOT NULL)) AS ok
    FROM (SELECT *, TRY_CAST(trim(parts[1]) AS INTEGER) AS p0, parts[2] AS p1_raw,
                 TRY_CAST(trim(parts[2]) AS INTEGER) AS p1
      FROM (SELECT *, string_split(trim(regexp_replace(companySize, '[,+]', '', 'g')), '-') AS parts
            FROM bronze_b)))),
silver_b AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY job_position, company_name
      ORDER BY job_posting_date DESC NULLS LAST, yoe, min_salary, max_salary, company_size_min,
               company_size_max, major_field, level, num_of_recruit, work_form, relation_fields,
               skills_extracted, city, district, source) AS rn FROM sb)
  WHERE rn = 1)"""


@register("silver_api_postings", _SILVER_B_SQL + """
SELECT * REPLACE (array_to_string(relation_fields, ',') AS relation_fields,
                  array_to_string(skills_extracted, ',') AS skills_extracted)
FROM silver_b
""")
def q_silver_api_postings(spark, d):
    """E2 board B: C3b, C4, C5, C7, C9, B9, B18-B20, W2 on nested records."""
    s = silver_board_b(api_bronze(spark, d))
    return s.withColumns({"relation_fields": F.array_join("relation_fields", ","),
                          "skills_extracted": F.array_join("skills_extracted", ",")})


@register("gold_union_fact", _SILVER_A_SQL + "," + _SILVER_B_SQL.removeprefix("\nWITH ") + f""",
view AS (SELECT * REPLACE (coalesce(work_form, '') AS work_form),
                {sql_row_key('company_name', 'job_position', 'job_posting_date')} AS JobPostingID,
                job_posting_date AS DateID
         FROM (SELECT * FROM silver UNION ALL BY NAME SELECT * FROM silver_b))
SELECT JobPostingID, {sql_key('company_name', 'major_field')} AS CompanyID,
       {sql_key('job_position', 'level', 'relation_fields', arrays=(2,))} AS JobPositionID,
       DateID, {sql_key('work_form')} AS WorkFormID, min_salary AS MinSalary,
       max_salary AS MaxSalary, yoe AS YOE, num_of_recruit AS NumOfRecruit
FROM view
""")
def q_gold_union_fact(spark, d):
    """E3 over both boards: S1 union by name, then fact_job."""
    view = gold_view([silver_board_a(postings_bronze(spark, d)), silver_board_b(api_bronze(spark, d))])
    return gold_tables(view)["fact_job"]


@register("silver_quality", f"""
WITH bronze AS ({_BRONZE_A_SQL}),
x AS (
  SELECT salary, contains(lower(salary), 'thỏa thuận') AS negotiable,
    CASE WHEN contains(lower(salary), 'thỏa thuận') THEN NULL
         WHEN regexp_matches(lower(salary), '\\d+')
         THEN TRY_CAST(regexp_extract(lower(salary), '(\\d+)', 1) AS BIGINT) * 1000000 END AS min_salary,
    yoe, CASE WHEN contains(y, 'không yêu cầu') THEN 0.0 WHEN contains(y, 'trên') THEN 5.5
              WHEN regexp_matches(y, '\\d+') THEN CAST(TRY_CAST(regexp_extract(y, '(\\d+)', 1) AS INTEGER) AS DOUBLE)
         END AS yoe_years,
    deadline_submit,
    CAST(try_strptime(replace(deadline_submit, {_sq(DEADLINE_LABEL)}, ''), '%d/%m/%Y') AS DATE) AS posting_date,
    company_size, TRY_CAST(regexp_extract(trim(lower(company_size)), '(\\d+)', 1) AS INTEGER) AS size_min,
    num_of_recruit, TRY_CAST(replace(num_of_recruit, ' người', '') AS INTEGER) AS recruits
  FROM (SELECT *, trim(lower(yoe)) AS y FROM bronze)),
agg AS (
  SELECT count(*) AS rows,
    CAST(sum(CASE WHEN salary IS NOT NULL AND min_salary IS NULL AND NOT coalesce(negotiable, false) THEN 1 ELSE 0 END) AS BIGINT) AS salary,
    CAST(sum(CASE WHEN yoe IS NOT NULL AND yoe_years IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS yoe,
    CAST(sum(CASE WHEN deadline_submit IS NOT NULL AND posting_date IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS deadline,
    CAST(sum(CASE WHEN company_size IS NOT NULL AND size_min IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS company_size,
    CAST(sum(CASE WHEN num_of_recruit IS NOT NULL AND recruits IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS headcount
  FROM x)
SELECT rows, 'salary' AS "check", salary AS failures FROM agg
UNION ALL SELECT rows, 'yoe', yoe FROM agg
UNION ALL SELECT rows, 'deadline', deadline FROM agg
UNION ALL SELECT rows, 'company_size', company_size FROM agg
UNION ALL SELECT rows, 'headcount', headcount FROM agg
""")
def q_silver_quality(spark, d):
    """Dirty-text report (§7.3): parse failures per field of board A."""
    return silver_quality_a(postings_bronze(spark, d))


_UNION_VIEW_SQL = _SILVER_A_SQL + "," + _SILVER_B_SQL.removeprefix("\nWITH ") + f""",
view AS (SELECT * REPLACE (coalesce(work_form, '') AS work_form),
                {sql_row_key('company_name', 'job_position', 'job_posting_date')} AS JobPostingID,
                job_posting_date AS DateID
         FROM (SELECT * FROM silver UNION ALL BY NAME SELECT * FROM silver_b))"""


def _union_gold(spark, d) -> dict[str, DataFrame]:
    # left lazy, so that each report reads only the columns it needs
    view = gold_view([silver_board_a(postings_bronze(spark, d)), silver_board_b(api_bronze(spark, d))])
    return {"view": view, **gold_tables(view)}


_GOLD_SQL = _UNION_VIEW_SQL + f""",
keyed AS (
  SELECT *, {sql_key('company_name', 'major_field')} AS CompanyID,
         {sql_key('job_position', 'level', 'relation_fields', arrays=(2,))} AS JobPositionID,
         {sql_key('work_form')} AS WorkFormID FROM view),
dim_company AS (SELECT DISTINCT company_name, major_field, CompanyID FROM keyed),
dim_jobposition AS (SELECT DISTINCT job_position, level, relation_fields, JobPositionID FROM keyed),
dim_date AS (SELECT DISTINCT DateID FROM view),
dim_workform AS (SELECT DISTINCT work_form, WorkFormID FROM keyed),
skill AS (SELECT JobPostingID, trim(unnest(skills_extracted)) AS SkillName FROM view),
dim_skills AS (SELECT DISTINCT SkillName, {sql_key('SkillName')} AS SkillID FROM skill),
fact_job AS (SELECT JobPostingID, CompanyID, JobPositionID, DateID, WorkFormID, yoe FROM keyed),
fact_jobskill AS (SELECT DISTINCT JobPostingID, {sql_key('SkillName')} AS SkillID FROM skill)"""

_GOLD_PKS = {"fact_job": "JobPostingID", "dim_company": "CompanyID", "dim_jobposition": "JobPositionID",
             "dim_date": "DateID", "dim_workform": "WorkFormID", "dim_skills": "SkillID"}
_GOLD_FKS = [("fact_job", "dim_company", "CompanyID"), ("fact_job", "dim_jobposition", "JobPositionID"),
             ("fact_job", "dim_date", "DateID"), ("fact_job", "dim_workform", "WorkFormID"),
             ("fact_jobskill", "fact_job", "JobPostingID"), ("fact_jobskill", "dim_skills", "SkillID")]


@register("gold_key_checks", _GOLD_SQL + """,
p_fact_job AS (SELECT JobPostingID, CompanyID, JobPositionID, DateID, WorkFormID FROM fact_job UNION ALL
  SELECT JobPostingID, CompanyID + 1, JobPositionID + 1, DateID + 20000, WorkFormID + 1 FROM fact_job WHERE yoe = 5.5),
p_dim_company AS (SELECT CompanyID FROM dim_company UNION ALL SELECT CompanyID FROM dim_company WHERE major_field = 'en'),
p_dim_jobposition AS (SELECT JobPositionID FROM dim_jobposition UNION ALL
  SELECT JobPositionID FROM dim_jobposition WHERE JobPositionID % 3 = 0),
p_dim_date AS (SELECT DateID FROM dim_date UNION ALL SELECT DateID FROM dim_date WHERE month(DateID) = 1),
p_dim_workform AS (SELECT WorkFormID FROM dim_workform UNION ALL SELECT WorkFormID FROM dim_workform),
p_dim_skills AS (SELECT SkillID FROM dim_skills UNION ALL SELECT SkillID FROM dim_skills WHERE SkillName = 'BUILDING'),
p_fact_jobskill AS (SELECT JobPostingID, SkillID FROM fact_jobskill UNION ALL
  SELECT md5(JobPostingID), SkillID + 1 FROM fact_jobskill WHERE SkillID % 7 = 0)
""" + " UNION ALL ".join(
    [f"SELECT 'pk_{t}' AS \"check\", (SELECT count(*) FROM (SELECT {k} FROM p_{t} GROUP BY 1 HAVING count(*) > 1)) AS violations"
     for t, k in _GOLD_PKS.items()] +
    [f"SELECT 'fk_{t}_{k}', (SELECT count(*) FROM p_{t} f WHERE f.{k} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM p_{u} d WHERE d.{k} = f.{k}))"
     for t, u, k in _GOLD_FKS]))
def q_gold_key_checks(spark, d):
    """The twelve declared keys on the star schema of both boards, with
    violations planted in every table. Boards share a JobPostingID when both
    list the same company, position and date: the union keeps both rows, and the
    key check reports them."""
    view = materialize(gold_view([silver_board_a(postings_bronze(spark, d)), silver_board_b(api_bronze(spark, d))]))
    t = gold_tables(view)
    f, s = t["fact_job"], t["fact_jobskill"]
    moved = f.where("YOE = 5.5").withColumns({
        "CompanyID": F.col("CompanyID") + 1, "JobPositionID": F.col("JobPositionID") + 1,
        "DateID": F.date_add("DateID", 20000), "WorkFormID": F.col("WorkFormID") + 1})
    strays = s.where("SkillID % 7 = 0").select(F.md5("JobPostingID").alias("JobPostingID"),
                                               (F.col("SkillID") + 1).alias("SkillID"))
    twice = {"dim_company": "MajorField = 'en'", "dim_jobposition": "JobPositionID % 3 = 0", "dim_date": "Month = 1",
             "dim_workform": "true", "dim_skills": "SkillName = 'BUILDING'"}
    t |= {n: t[n].unionByName(t[n].where(c)) for n, c in twice.items()}
    t |= {"fact_job": f.unionByName(moved), "fact_jobskill": s.unionByName(strays)}
    return key_checks(t, _GOLD_PKS, _GOLD_FKS)


@register("gold_roundtrip", _GOLD_SQL + "\n" + " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}"
    for t in ("view", "dim_company", "dim_jobposition", "dim_date", "dim_workform", "dim_skills", "fact_job", "fact_jobskill")))
def q_gold_roundtrip(spark, d):
    """The eight gold tables of both boards written, published as tables and read back."""
    root = scratch_path(spark, "gold")
    view = gold_view([silver_board_a(postings_bronze(spark, d)), silver_board_b(api_bronze(spark, d))])
    write_layer(view, root, "gold", "view")
    view = read_layer(spark, root, "gold", "view")
    names = list(write_tables(gold_tables(view), root)) + ["view"]
    stored = {f"jobstar_{n}": read_layer(spark, root, "gold", n) for n in names}
    load_warehouse(spark, stored, path_root=f"{root}/warehouse")
    counts = [spark.table(f"jobstar_{n}").agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(n).alias("table_name"), "n_rows")
              for n in names]
    return reduce(DataFrame.unionByName, counts)


_GOLD_NAMES = ("view", "dim_company", "dim_jobposition", "dim_date", "dim_workform", "dim_skills", "fact_job", "fact_jobskill")
_BOTH_SQL = "SELECT * FROM silver UNION ALL BY NAME SELECT * FROM silver_b"
_COUNTS_SQL = " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}" for t in _GOLD_NAMES)


@register("gold_snapshots", f"""
SELECT CAST(1 AS INTEGER) AS version, * FROM ({_GOLD_SQL.replace(_BOTH_SQL, "SELECT * FROM silver")} {_COUNTS_SQL})
UNION ALL SELECT CAST(2 AS INTEGER), * FROM ({_GOLD_SQL} {_COUNTS_SQL})
""")
def q_gold_snapshots(spark, d):
    """The eight gold tables published as one, first of board A, then of both boards; both versions
    read back through their manifests."""
    root = scratch_path(spark, "gold-snapshots")
    a, b = silver_board_a(postings_bronze(spark, d)), silver_board_b(api_bronze(spark, d))
    counts = []
    for silvers in ([a], [a, b]):
        view = materialize(gold_view(silvers), "gold-view")
        version = snapshots.publish(spark, root, {"view": view, **gold_tables(view)})
        counts += [t.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(version).alias("version"), F.lit(n).alias("table_name"), "n_rows")
                   for n, t in snapshots.read_snapshot(spark, root, version=version).items()]
    return reduce(DataFrame.unionByName, counts)


@register("gold_breakdowns", _UNION_VIEW_SQL + """
SELECT kind, name, count(*) AS n_postings FROM (
  SELECT 'city' AS kind, city AS name FROM view UNION ALL SELECT 'level', level FROM view
  UNION ALL SELECT 'source', source FROM view)
GROUP BY 1, 2
""")
def q_gold_breakdowns(spark, d):
    """G10 dashboard: postings by city, level and source in one pass over the view."""
    view = gold_view([silver_board_a(postings_bronze(spark, d)), silver_board_b(api_bronze(spark, d))])
    kinds = F.array(*[F.struct(F.lit(c).alias("kind"), F.col(c).alias("name")) for c in ("city", "level", "source")])
    return distribution(view.select(F.inline(kinds)), ["kind", "name"], out="n_postings")


@register("gold_top_skills", _UNION_VIEW_SQL + """
SELECT SkillName, count(DISTINCT JobPostingID) AS n_postings
FROM (SELECT JobPostingID, trim(unnest(skills_extracted)) AS SkillName FROM view)
GROUP BY SkillName ORDER BY n_postings DESC, SkillName ASC LIMIT 10
""")
def q_gold_top_skills(spark, d):
    """G8 dashboard: bridge joined to the skill dimension, top 10 skills."""
    g = _union_gold(spark, d)
    named = lookup(g["fact_jobskill"], g["dim_skills"], [("SkillID", "SkillID")], ["SkillName"])
    return top_n(named, ["SkillName"], 10, count_distinct="JobPostingID", out="n_postings")


@register("gold_top_companies", _UNION_VIEW_SQL + """
SELECT company_name AS CompanyName, count(*) AS n_postings FROM view
GROUP BY company_name ORDER BY n_postings DESC, CompanyName ASC LIMIT 10
""")
def q_gold_top_companies(spark, d):
    """G9 dashboard: most active companies (fact joined to company names)."""
    g = _union_gold(spark, d)
    named = lookup(g["fact_job"], g["dim_company"], [("CompanyID", "CompanyID")], ["CompanyName"])
    return top_n(named, ["CompanyName"], 10, out="n_postings")


@register("gold_distribution", _UNION_VIEW_SQL + """
SELECT work_form AS WorkForm, CAST(year(DateID) AS INTEGER) AS Year, count(*) AS n_postings
FROM view GROUP BY 1, 2
""")
def q_gold_distribution(spark, d):
    """G10 dashboard: postings per work form and year (fact x dimensions)."""
    g = _union_gold(spark, d)
    f = lookup(g["fact_job"], g["dim_workform"], [("WorkFormID", "WorkFormID")], ["WorkForm"])
    f = lookup(f, g["dim_date"], [("DateID", "DateID")], ["Year"])
    return distribution(f, ["WorkForm", "Year"], out="n_postings")


@register("stream_landing", "SELECT * FROM orders")
def q_stream_landing(spark, d):
    """A1 -> A3 incrementally: raw JSON files landed by the checkpointed
    streaming job (two runs; the second finds no new file), then scanned."""
    o = table(spark, d, "orders")
    src, out, ckpt = (scratch_path(spark, n) for n in ("raw", "landed", "stream-ckpt"))
    o.write.mode("overwrite").json(src)
    for _ in range(2):
        land_stream(spark, src, o.schema, out, ckpt, multiline=False, source="orders")
    return spark.read.parquet(out).select(*o.columns)


def _silver_b_fixed_sql() -> str:
    """Board-B silver SQL in fixed mode: the reference-mode SQL with the two
    documented differences (folded dedup keys, trimmed Unicode district)."""
    sql = _SILVER_B_SQL
    ref_keys = "SELECT jobTitle AS job_position, companyName AS company_name,"
    ref_district = (r"regexp_extract(workingLocations[1].address, '(?i)(Quận|Q\.)\s*([^\.,\d]+)', 2)"
                    " AS district,")
    assert ref_keys in sql and ref_district in sql
    sql = sql.replace(ref_keys, "SELECT trim(lower(jobTitle)) AS job_position, trim(companyName) AS company_name,")
    return sql.replace(ref_district, "nullif(trim(" + ref_district.removesuffix(" AS district,")
                       + "), '') AS district,")


@register("silver_api_postings_fixed", _silver_b_fixed_sql() + """
SELECT * REPLACE (array_to_string(relation_fields, ',') AS relation_fields,
                  array_to_string(skills_extracted, ',') AS skills_extracted)
FROM silver_b
""")
def q_silver_api_postings_fixed(spark, d):
    """E2 board B, fixed rules: case-folded dedup keys, district trimmed/null."""
    s = silver_board_b(api_bronze(spark, d), mode="fixed")
    return s.withColumns({"relation_fields": F.array_join("relation_fields", ","),
                          "skills_extracted": F.array_join("skills_extracted", ",")})
