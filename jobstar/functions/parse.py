"""Domain parsers over free text.

Each parser has a ``mode``: ``"reference"`` reproduces the source job's
rules exactly (except that dirty text gives null instead of aborting the
job under ANSI), ``"fixed"`` repairs the documented defects.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from jobstar.functions.text import as_col, strip_label, to_int, to_long, trim_lower

# ---- fixed values (must equal the source job's) -------------------------
NEGOTIABLE = "thỏa thuận"            # salary text meaning "negotiable"
NO_EXPERIENCE = "không yêu cầu"      # "no experience required"
ABOVE = "trên"                       # "above N years"
ABOVE_YEARS = 5.5                    # value the source assigns to "above"
MILLION = 1_000_000                  # salary numbers are millions of VND
USD_TO_VND = 24000                   # exchange rate of the API board
FULL_TIME = "Toàn thời gian"
PART_TIME = "Bán thời gian"
FULL_TIME_CODE = 1
HEADCOUNT_LABEL = " người"
FIRST_NUMBER = r"(\d+)"               # first digit run
NUMBER_AFTER_DASH = r"\d+\s*-\s*(\d+)"  # second number of "n - m"
SIZE_AFTER_DASH = r"-(\d+)"          # upper company size
# Extra words recognised only by mode="fixed".
NEGOTIABLE_FIXED = ["thỏa thuận", "thoả thuận", "negotiable", "negotiation"]
UP_TO_FIXED = ["tới", "đến", "up to"]
MILLION_UNITS = r"triệu|\dtr\b|\str\b"
MILLIONS_BELOW = 1000                # a VND amount without a unit below this is in millions
# -------------------------------------------------------------------------


def _times(c: Column, k: int) -> Column:
    # bigint product; overflow gives null instead of an ANSI error
    return F.try_multiply(c, F.lit(k).cast("bigint"))


def salary_range(text, mode: str = "reference", unit: int = MILLION,
                 usd_rate: int = USD_TO_VND) -> tuple[Column, Column]:
    """Salary text -> (min, max) as bigint VND.

    reference: negotiable -> nulls; min = first digit run x unit; max = the
    number after ``n - `` x unit, else null. So "tới 30 triệu" gives
    (30M, null) and "12.5 - 20" gives 12M.
    fixed: grouped digits and decimals are read as numbers, however long; two
    numbers with a dash or "đến"/"tới" between them are a range, "up to"
    before one fills max only; USD amounts are converted with ``usd_rate``, and
    the million unit applies where the text says so or the amount is too small to be VND.
    """
    s = F.lower(as_col(text))
    if mode == "reference":
        neg = s.contains(NEGOTIABLE)
        lo = F.when(neg, F.lit(None)).when(
            s.rlike(FIRST_NUMBER), _times(to_long(F.regexp_extract(s, FIRST_NUMBER, 1)), unit))
        hi = F.when(neg, F.lit(None)).when(
            s.rlike(NUMBER_AFTER_DASH),
            _times(to_long(F.regexp_extract(s, NUMBER_AFTER_DASH, 1)), unit))
        return lo, hi
    if mode != "fixed":
        raise ValueError(f"unknown mode {mode!r}")
    neg = F.lit(False)
    for w in NEGOTIABLE_FIXED:
        neg = neg | F.coalesce(s.contains(w), F.lit(False))
    upto = F.lit(False)
    for w in UP_TO_FIXED:
        upto = upto | F.coalesce(s.contains(w), F.lit(False))
    # 1,000,000 / 1.000.000 -> 1000000: a separator between a digit and exactly three digits
    s2 = F.regexp_replace(s, r"(?<=\d)[,.](?=\d{3}(?!\d))", "")
    s2 = F.regexp_replace(s2, r"(?<=\d),(?=\d)", ".")       # decimal comma
    nums = F.regexp_extract_all(s2, F.lit(r"(\d+(?:\.\d+)?)"), F.lit(1))
    usd = s.contains("usd") | s.contains("$")

    def amount(i: int) -> Column:
        n = F.get(nums, i).try_cast("decimal(24,6)")
        factor = (F.when(usd, F.lit(usd_rate)).when(s2.rlike(MILLION_UNITS) | (n < MILLIONS_BELOW), F.lit(unit))
                   .otherwise(F.lit(1)))
        return F.try_multiply(n, factor.cast("decimal(10,0)"))

    ranged = s2.rlike(r"\d[^\d]*?(?:-|–|đến|tới)[^\d]*\d")
    lo = F.when(neg, F.lit(None)).when(upto & ~ranged, F.lit(None)).otherwise(amount(0))
    hi = F.when(neg, F.lit(None)).when(ranged, amount(1)).when(upto, amount(0))
    return F.round(lo).try_cast("bigint"), F.round(hi).try_cast("bigint")


def experience_years(text) -> Column:
    """Years-of-experience text -> double. Order matters:
    "không yêu cầu" -> 0, "trên" (any number) -> 5.5, first digit run,
    else null."""
    s = trim_lower(text)
    return (F.when(s.contains(NO_EXPERIENCE), F.lit(0.0))
             .when(s.contains(ABOVE), F.lit(ABOVE_YEARS))
             .when(s.rlike(r"\d+"), to_int(F.regexp_extract(s, r"(\d+)", 1)).cast("double")))


def size_range(text, mode: str = "reference") -> tuple[Column, Column]:
    """Company size text of the scraped board -> (min, max) int.

    reference: min = first digit run; max = min when '+' is present or no
    '-' is present, else the digits right after '-'. "1,000+" gives (1, 1).
    fixed: digit grouping removed, spaces allowed around '-', open-ended
    sizes ("1000+") have max null.
    """
    s = trim_lower(text)
    if mode == "reference":
        lo = to_int(F.regexp_extract(s, FIRST_NUMBER, 1))
        hi = (F.when(s.contains("+"), lo)
               .when(~s.contains("-"), lo)
               .otherwise(to_int(F.regexp_extract(s, SIZE_AFTER_DASH, 1))))
        return lo, hi
    if mode != "fixed":
        raise ValueError(f"unknown mode {mode!r}")
    s2 = F.regexp_replace(s, r"(\d)[,.](\d)", "$1$2")
    lo = to_int(F.regexp_extract(s2, r"(\d+)", 1))
    hi = (F.when(s2.contains("+"), F.lit(None).cast("int"))
           .when(~s2.contains("-"), lo)
           .otherwise(to_int(F.regexp_extract(s2, r"-\s*(\d+)", 1))))
    return lo, hi


def size_range_struct(text) -> Column:
    """Company size text of the API board -> struct<min:int, max:int>.

    Drop ',' and '+', split on '-', read the first two parts. One part ->
    max null; an unreadable part (e.g. "500-") -> the whole struct null.
    """
    t = as_col(text)
    parts = F.split(F.trim(F.regexp_replace(t, r"[,+]", "")), "-")
    p0 = to_int(F.trim(F.get(parts, 0)))
    p1_raw = F.get(parts, 1)
    p1 = to_int(F.trim(p1_raw))
    ok = (t != F.lit("")) & p0.isNotNull() & (p1_raw.isNull() | p1.isNotNull())
    return F.when(ok, F.struct(p0.alias("min"), p1.alias("max")))


def currency_to_vnd(amount, currency, rates: dict[str, int] | None = None) -> Column:
    """C4: amount in a currency -> VND. 0, null or an unknown currency -> null."""
    rates = rates or {"USD": USD_TO_VND, "VND": 1}
    a, ccy = as_col(amount), as_col(currency)
    valid = a.isNotNull() & (a != F.lit(0))
    out = None
    for code, rate in rates.items():
        cond = (ccy == F.lit(code)) & valid
        val = a if rate == 1 else _times(a, rate)
        out = F.when(cond, val) if out is None else out.when(cond, val)
    return out


def decode_work_form(code, full_time_code: int = FULL_TIME_CODE,
                     null_is_part_time: bool = True) -> Column:
    """1 -> full time, anything else -> part time. The source maps null
    to part time too; ``null_is_part_time=False`` keeps null."""
    c = as_col(code)
    out = F.when(c == F.lit(full_time_code), F.lit(FULL_TIME))
    if not null_is_part_time:
        out = F.when(c.isNull(), F.lit(None).cast("string")).when(c == F.lit(full_time_code), F.lit(FULL_TIME))
    return out.otherwise(F.lit(PART_TIME))


def headcount(text, label: str = HEADCOUNT_LABEL) -> Column:
    """C11: "3 người" -> 3; words ("Nhiều") -> null."""
    return to_int(strip_label(text, label))
