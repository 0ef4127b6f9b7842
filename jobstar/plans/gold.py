"""Silver -> gold star schema (E3): five dimensions, the fact, the bridge
and the wide ``view``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobstar import schemas
from jobstar.functions.keys import row_key, stable_key
from jobstar.operators.conform import to_schema, union_sources
from jobstar.operators.dedup import latest_per_key
from jobstar.operators.star import (
    DimRef, build_bridge, build_date_dimension, build_dimension, build_fact, explode_items,
)

POSTING_KEY = ["company_name", "job_position", "job_posting_date"]

COMPANY = {"CompanyName": "company_name", "MajorField": "major_field"}
POSITION = {"JobPosition": "job_position", "Level": "level", "RelationFields": "relation_fields"}
WORKFORM = {"WorkForm": "work_form"}


# ---- fixed values: what the posting date means on each board -----------
DATE_KIND = {"topcv": "deadline", "vietnamworks": "approved"}
# -------------------------------------------------------------------------


def gold_view(silvers: list[DataFrame], posting_key: str = "md5", date_kind: bool = False,
              latest_across_sources: bool = False) -> DataFrame:
    """Union of the conformed sources + posting key and date key (the
    ``view`` table). Both boards keep their rows (no cross-source dedup).

    ``posting_key="murmur3"`` reproduces the source's 32-bit ``hash`` ids
    exactly (nulls are skipped, so ('a', null, d) and (null, 'a', d)
    collide); the default md5 key keeps nulls apart and has 128 bits.
    ``date_kind`` adds what ``job_posting_date`` means per source;
    ``latest_across_sources`` keeps one row per (position, company) over
    both boards instead of one per board.
    """
    df = union_sources([to_schema(s, schemas.SILVER) for s in silvers])
    if latest_across_sources:
        df = latest_per_key(df, ["job_position", "company_name"], ["job_posting_date"])
    if date_kind:
        kind = None
        for src, k in DATE_KIND.items():
            cond = F.col("source") == F.lit(src)
            kind = F.when(cond, F.lit(k)) if kind is None else kind.when(cond, F.lit(k))
        df = df.withColumn("date_kind", kind)
    key = F.hash(*POSTING_KEY).cast("string") if posting_key == "murmur3" else row_key(df, POSTING_KEY)
    return (df.withColumn("JobPostingID", key)
              .withColumn("DateID", F.to_date("job_posting_date"))
              .withColumn("work_form", F.coalesce(F.col("work_form").cast("string"), F.lit(""))))


def gold_tables(view: DataFrame, method: str = "derive", fold_skills: bool = False) -> dict[str, DataFrame]:
    """All gold tables from the ``view``. Pass a materialised view (see
    ``pipeline.run_gold``) so the eight outputs do not recompute silver.

    ``fold_skills`` keys skills by their trimmed lower-case text, so
    "Python" and "python" are one skill; the dimension keeps a display name
    (the smallest spelling, so it is deterministic)."""
    if fold_skills:
        return _with_folded_skills(gold_tables(view, method), view)
    dim_company = build_dimension(view, COMPANY, "CompanyID")
    dim_position = build_dimension(view, POSITION, "JobPositionID")
    dim_date = build_date_dimension(view, "DateID")
    dim_workform = build_dimension(view, WORKFORM, "WorkFormID")
    skills = explode_items(view, [], "skills_extracted", "SkillName")
    dim_skills = build_dimension(skills, {"SkillName": "SkillName"}, "SkillID")
    dims = [DimRef("CompanyID", COMPANY, dim_company),
            DimRef("JobPositionID", POSITION, dim_position),
            DimRef("WorkFormID", WORKFORM, dim_workform)]
    fact = build_fact(view, dims, {"JobPostingID": "JobPostingID", "DateID": "DateID",
                                   "MinSalary": "min_salary", "MaxSalary": "max_salary",
                                   "YOE": "yoe", "NumOfRecruit": "num_of_recruit"},
                      method=method)
    bridge = build_bridge(view, "JobPostingID", "skills_extracted", "SkillName", "SkillID",
                          dim=dim_skills if method == "join" else None)
    return {
        "dim_company": to_schema(dim_company, schemas.GOLD["dim_company"]),
        "dim_jobposition": to_schema(dim_position, schemas.GOLD["dim_jobposition"]),
        "dim_date": to_schema(dim_date, schemas.GOLD["dim_date"]),
        "dim_workform": to_schema(dim_workform, schemas.GOLD["dim_workform"]),
        "dim_skills": to_schema(dim_skills, schemas.GOLD["dim_skills"]),
        "fact_job": to_schema(fact, schemas.GOLD["fact_job"]),
        "fact_jobskill": to_schema(bridge, schemas.GOLD["fact_jobskill"]),
    }


def _with_folded_skills(tables: dict[str, DataFrame], view: DataFrame) -> dict[str, DataFrame]:
    items = explode_items(view, ["JobPostingID"], "skills_extracted", "SkillName")
    items = items.withColumn("SkillKey", F.lower("SkillName"))
    items = items.withColumn("SkillID", stable_key(items, ["SkillKey"]))
    dim = items.groupBy("SkillID").agg(F.min("SkillName").alias("SkillName"))
    bridge = items.select("JobPostingID", "SkillID").dropDuplicates()
    return {**tables,
            "dim_skills": to_schema(dim, schemas.GOLD["dim_skills"]),
            "fact_jobskill": to_schema(bridge, schemas.GOLD["fact_jobskill"])}
