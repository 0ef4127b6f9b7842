"""DataFrame -> DataFrame operators. Every operator takes column names as
parameters, so it runs on any table."""

from jobstar.operators.dedup import latest_per_key  # noqa: F401
from jobstar.operators.conform import (  # noqa: F401
    rename, to_schema, union_sources, required_filter, with_source, with_ingest_time, with_row_key,
)
from jobstar.operators.joins import lookup  # noqa: F401
from jobstar.operators.star import (  # noqa: F401
    build_dimension, build_date_dimension, explode_items, build_bridge, build_fact,
)
from jobstar.operators.checks import pk_violations, fk_violations  # noqa: F401
from jobstar.operators.reports import top_n, distribution  # noqa: F401
