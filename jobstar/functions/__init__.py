"""Pure Column -> Column expressions. Every function here stays JVM-side
(no Python UDFs), so it runs inside whole-stage codegen and is safe under
ANSI mode: dirty text becomes null instead of failing the job."""

from jobstar.functions.text import (  # noqa: F401
    as_col, trim_lower, strip_label, to_int, to_long, first_digits, blank_to_null,
    default_if_null, non_blank,
)
from jobstar.functions.dates import (  # noqa: F401
    parse_date, parse_iso_date, calendar_parts, deadline_to_date,
)
from jobstar.functions.parse import (  # noqa: F401
    salary_range, experience_years, size_range, size_range_struct, currency_to_vnd,
    decode_work_form, headcount,
)
from jobstar.functions.arrays import (  # noqa: F401
    pick, city_district, clean_list, field_of_first, project_field, district_from_address,
)
from jobstar.functions.tagging import keyword_tags, SKILL_KEYWORDS  # noqa: F401
from jobstar.functions.keys import row_key, stable_key, key_text  # noqa: F401
