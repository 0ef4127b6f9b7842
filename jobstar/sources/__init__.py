"""Readers and sinks."""

from jobstar.sources.readers import read_json_records, read_envelopes, read_layer, layer_path  # noqa: F401
from jobstar.sources.sinks import (  # noqa: F401
    write_layer, land_bronze, write_tables, load_warehouse, load_jdbc, jdbc_credentials,
)
