"""Bronze -> silver for both job boards.

One projection per board, all native expressions (no Python UDF), a
required-field filter that Catalyst pushes below the projection, the
conforming cast to ``SILVER`` and the keep-latest dedup.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobstar import schemas
from jobstar.functions.arrays import (
    city_district, clean_list, district_from_address, field_of_first, project_field,
)
from jobstar.functions.dates import deadline_to_date, parse_iso_date
from jobstar.functions.parse import (
    currency_to_vnd, decode_work_form, experience_years, headcount, salary_range, size_range,
    size_range_struct,
)
from jobstar.functions.tagging import with_keyword_tags
from jobstar.functions.text import nfc, trim_lower
from jobstar.operators.conform import required_filter, to_schema
from jobstar.operators.dedup import latest_per_key
from jobstar.sources.readers import CORRUPT_COL

# ---- fixed values: source tags of the two boards ------------------------
SOURCE_A = "topcv"
SOURCE_B = "vietnamworks"
# -------------------------------------------------------------------------
REQUIRED_A = ["job_position", "company_name", "requirements", "description"]
TEXT_FIELDS_A = ["title", "company_name", "salary", "yoe", "deadline_submit", "company_size",
                 "num_of_recruit", "requirements"]
TEXT_FIELDS_B = ["jobTitle", "companyName", "companySize"]
DEDUP_KEYS = ["job_position", "company_name"]


def _valid_records(bronze: DataFrame) -> DataFrame:
    """Bronze keeps malformed raw records (text in ``_corrupt_record``);
    silver reads only the parsed ones."""
    if CORRUPT_COL in bronze.columns:
        return bronze.filter(F.col(CORRUPT_COL).isNull())
    return bronze


def silver_board_a(bronze: DataFrame, mode: str = "reference",
                   required: list[str] | None = REQUIRED_A, dedup: bool = True,
                   normalize: bool = False) -> DataFrame:
    """Scraped board. ``mode`` selects the parsers' reference or fixed rules;
    ``normalize=True`` brings the parsed text fields to NFC first.

    Only the keys and the date are computed before the filter and the
    keep-latest step; salaries are parsed and texts tagged on the rows that stay.
    Ties on the date go to the smallest raw ``id``, then to a hash of the raw row.
    """
    bronze = _valid_records(bronze)
    if normalize:
        bronze = bronze.withColumns({c: nfc(c) for c in TEXT_FIELDS_A})
    raw = bronze.columns
    df = bronze.withColumns({"job_position": trim_lower("title"), "__company": F.trim("company_name"),
                             "job_posting_date": deadline_to_date("deadline_submit")})
    if required:
        df = required_filter(df, ["__company" if c == "company_name" else c for c in required])
    if dedup:
        df = latest_per_key(df, ["job_position", "__company"], ["job_posting_date"],
                            tie_break=[F.col("id").asc_nulls_last(), F.xxhash64(*raw)])
    df = with_keyword_tags(df, "requirements", "__skills")
    lo, hi = salary_range("salary", mode)
    size_lo, size_hi = size_range("company_size", mode)
    city, district = city_district("area")
    df = df.select(
        "job_position",
        F.col("__company").alias("company_name"),
        experience_years("yoe").alias("yoe"),
        "job_posting_date",
        lo.alias("min_salary"), hi.alias("max_salary"),
        size_lo.alias("company_size_min"), size_hi.alias("company_size_max"),
        "major_field", "level",
        headcount("num_of_recruit").alias("num_of_recruit"),
        "work_form",
        clean_list("relation_fields").alias("relation_fields"),
        F.col("__skills").alias("skills_extracted"),
        city.alias("city"), district.alias("district"),
        F.lit(SOURCE_A).alias("source"),
    )
    return to_schema(df, schemas.SILVER)


def silver_board_b(bronze: DataFrame, mode: str = "reference", dedup: bool = True,
                   normalize: bool = False, required: list[str] | None = None) -> DataFrame:
    """API board. In ``mode="fixed"`` the dedup keys are case-folded and
    trimmed like board A's, and the district parser is Unicode-aware;
    ``normalize=True`` brings the parsed text fields to NFC first."""
    bronze = _valid_records(bronze)
    if normalize:
        bronze = bronze.withColumns({c: nfc(c) for c in TEXT_FIELDS_B})
    size = size_range_struct("companySize")
    title = trim_lower("jobTitle") if mode == "fixed" else F.col("jobTitle")
    company = F.trim("companyName") if mode == "fixed" else F.col("companyName")
    df = bronze.select(
        title.alias("job_position"),
        company.alias("company_name"),
        F.col("yearsOfExperience").cast("double").alias("yoe"),
        parse_iso_date("approvedOn").alias("job_posting_date"),
        currency_to_vnd("salaryMin", "salaryCurrency").alias("min_salary"),
        currency_to_vnd("salaryMax", "salaryCurrency").alias("max_salary"),
        size["min"].alias("company_size_min"), size["max"].alias("company_size_max"),
        F.col("jobFunction.parentName").alias("major_field"),
        F.col("jobLevelVI").alias("level"),
        F.col("numberOfRecruits").alias("num_of_recruit"),
        decode_work_form("typeWorkingId").alias("work_form"),
        project_field("jobFunction.children", "name").alias("relation_fields"),
        project_field("skills", "skillName").alias("skills_extracted"),
        field_of_first("workingLocations", "cityNameVI").alias("city"),
        district_from_address(field_of_first("workingLocations", "address"), mode).alias("district"),
        F.lit(SOURCE_B).alias("source"),
    )
    if required:
        df = required_filter(df, required)
    df = to_schema(df, schemas.SILVER)
    return latest_per_key(df, DEDUP_KEYS, ["job_posting_date"]) if dedup else df


def silver_quality_a(bronze: DataFrame, mode: str = "reference") -> DataFrame:
    """Parse-failure counts of board A's text fields (see
    ``operators.checks.parse_failures``)."""
    from jobstar.operators.checks import parse_failures
    from jobstar.functions.parse import NEGOTIABLE
    lo, _ = salary_range("salary", mode)
    size_lo, _ = size_range("company_size", mode)
    corrupt = [CORRUPT_COL] if CORRUPT_COL in bronze.columns else []
    x = bronze.select(
        *corrupt,
        "salary", lo.alias("min_salary"), F.lower("salary").contains(NEGOTIABLE).alias("negotiable"),
        "yoe", experience_years("yoe").alias("yoe_years"),
        "deadline_submit", deadline_to_date("deadline_submit").alias("posting_date"),
        "company_size", size_lo.alias("size_min"),
        "num_of_recruit", headcount("num_of_recruit").alias("recruits"))
    return parse_failures(x, {"salary": ("salary", "min_salary"), "yoe": ("yoe", "yoe_years"),
                              "deadline": ("deadline_submit", "posting_date"),
                              "company_size": ("company_size", "size_min"),
                              "headcount": ("num_of_recruit", "recruits")},
                          excused={"salary": "negotiable"},
                          flags={"malformed": CORRUPT_COL} if corrupt else None)
