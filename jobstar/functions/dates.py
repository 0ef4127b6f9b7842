"""Date scalars."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from jobstar.functions.text import as_col, strip_label

# ---- fixed values: deadline label of the scraped board, day-first format
DEADLINE_LABEL = "Hạn nộp hồ sơ: "
DEADLINE_FORMAT = "dd/MM/yyyy"
# -------------------------------------------------------------------------


def parse_date(c, fmt: str) -> Column:
    """Text -> date by pattern; text that does not parse gives null."""
    return F.try_to_date(as_col(c), fmt)


def parse_iso_date(c) -> Column:
    """ISO date or date-time text -> the date as written.

    ``2025-07-24T10:00:00+07:00`` gives 2025-07-24 (the offset is not
    applied, as in the reference). Bad text gives null.
    """
    return as_col(c).try_cast("date")


def deadline_to_date(c, label: str = DEADLINE_LABEL, fmt: str = DEADLINE_FORMAT) -> Column:
    """Strip the fixed label, then parse day-first."""
    return parse_date(strip_label(c, label), fmt)


def calendar_parts(c) -> dict[str, Column]:
    """Day, month, quarter, year of a date; null date -> null parts."""
    d = as_col(c)
    return {"Day": F.dayofmonth(d), "Month": F.month(d), "Quarter": F.quarter(d), "Year": F.year(d)}
