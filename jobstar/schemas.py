"""Explicit schemas for every layer.

Bronze schemas are applied on read (no inference); silver and gold are
asserted on write through ``operators.conform.to_schema``.
"""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType, DateType, DoubleType, IntegerType, LongType, StringType,
    StructField, StructType, TimestampType,
)

S = StringType()
ARR_S = ArrayType(StringType())


def _struct(*fields) -> StructType:
    return StructType([StructField(n, t, True) for n, t in fields])


# Bronze A: scraped job board, one JSON array of flat objects per file.
BRONZE_A = _struct(
    ("id", S), ("title", S), ("company_name", S), ("salary", S), ("city", S),
    ("yoe", S), ("deadline_submit", S), ("main_industry", ARR_S),
    ("description", S), ("requirements", S), ("work_address", S),
    ("company_size", S), ("major_field", S), ("level", S),
    ("num_of_recruit", S), ("work_form", S), ("gender_require", S),
    ("relation_fields", ARR_S), ("skills", ARR_S), ("area", ARR_S),
    ("update_time", S), ("remain_time", S),
)

# Bronze B: API job board; only the fields the silver step reads.
BRONZE_B = _struct(
    ("jobTitle", S), ("companyName", S), ("yearsOfExperience", LongType()),
    ("approvedOn", S), ("salaryMin", LongType()), ("salaryMax", LongType()),
    ("salaryCurrency", S), ("companySize", S),
    ("jobFunction", _struct(("parentName", S),
                            ("children", ArrayType(_struct(("name", S)))))),
    ("jobLevelVI", S), ("numberOfRecruits", LongType()),
    ("typeWorkingId", IntegerType()),
    ("workingLocations", ArrayType(_struct(("cityNameVI", S), ("address", S)))),
    ("skills", ArrayType(_struct(("skillName", S)))),
)

# API response envelope: {"data": [job, ...], "meta": {"nbPages": n}}.
ENVELOPE_B = _struct(("data", ArrayType(BRONZE_B)),
                     ("meta", _struct(("nbPages", LongType()))))

SILVER = _struct(
    ("job_position", S), ("company_name", S), ("yoe", DoubleType()),
    ("job_posting_date", DateType()), ("min_salary", LongType()),
    ("max_salary", LongType()), ("company_size_min", IntegerType()),
    ("company_size_max", IntegerType()), ("major_field", S), ("level", S),
    ("num_of_recruit", LongType()), ("work_form", S),
    ("relation_fields", ARR_S), ("skills_extracted", ARR_S),
    ("city", S), ("district", S), ("source", S),
)

SILVER_COLUMNS = [f.name for f in SILVER.fields]

GOLD = {
    "dim_company": _struct(("CompanyName", S), ("MajorField", S), ("CompanyID", LongType())),
    "dim_jobposition": _struct(("JobPosition", S), ("Level", S), ("RelationFields", ARR_S),
                               ("JobPositionID", LongType())),
    "dim_date": _struct(("DateID", DateType()), ("Day", IntegerType()), ("Month", IntegerType()),
                        ("Quarter", IntegerType()), ("Year", IntegerType())),
    "dim_workform": _struct(("WorkForm", S), ("WorkFormID", LongType())),
    "dim_skills": _struct(("SkillName", S), ("SkillID", LongType())),
    "fact_job": _struct(("JobPostingID", S), ("CompanyID", LongType()),
                        ("JobPositionID", LongType()), ("DateID", DateType()),
                        ("WorkFormID", LongType()), ("MinSalary", LongType()),
                        ("MaxSalary", LongType()), ("YOE", DoubleType()),
                        ("NumOfRecruit", LongType())),
    "fact_jobskill": _struct(("JobPostingID", S), ("SkillID", LongType())),
}

INGEST_TIME = StructField("ingest_time", TimestampType(), True)
