"""Array and struct scalars."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from jobstar.functions.text import as_col

# ---- fixed values (must equal the source job's) -------------------------
GENERIC_CATEGORY = "Việc làm IT"     # site-wide category dropped from lists
DISTRICT_PATTERN = r"(?i)(Quận|Q\.)\s*([^\.,\d]+)"   # group 2 = district
# -------------------------------------------------------------------------
# Unicode-aware variant so that "QUẬN" also matches under Java regex.
DISTRICT_PATTERN_FIXED = r"(?iu)(Quận|Q\.)\s*([^\.,\d]+)"


def pick(arr, n: int) -> Column:
    """1-based item; short or null array -> null."""
    return F.try_element_at(as_col(arr), F.lit(n))


def city_district(arr) -> tuple[Column, Column]:
    """First and second item of an area list."""
    return pick(arr, 1), pick(arr, 2)


def clean_list(arr, value: str = GENERIC_CATEGORY) -> Column:
    """Drop every item equal to ``value``; null items stay."""
    return F.array_remove(as_col(arr), value)


def field_of_first(arr, field: str) -> Column:
    """``arr[0].field``; empty or null array -> null."""
    return F.get(as_col(arr), 0)[field]


def project_field(arr, field: str) -> Column:
    """array<struct> -> array of one field (null item -> null)."""
    return F.transform(as_col(arr), lambda x: x[field])


def district_from_address(address, mode: str = "reference") -> Column:
    """District after "Quận"/"Q." in a street address.

    reference: no match -> '', "Quận 1" -> ' ' (digits stop the capture).
    fixed: case-insensitive for Vietnamese capitals, trimmed, '' -> null.
    """
    a = as_col(address)
    if mode == "reference":
        return F.regexp_extract(a, DISTRICT_PATTERN, 2)
    return F.nullif(F.trim(F.regexp_extract(a, DISTRICT_PATTERN_FIXED, 2)), F.lit(""))
