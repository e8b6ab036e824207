from curate.sources.jdbc import jdbc_options, probe_jdbc, read_jdbc
from curate.sources.landed import accepted_details, lookup_details, search_hits
from curate.sources.readers import (
    read_csv,
    read_json_records,
    read_json_union,
    read_parquet,
    records_by_union,
    union_of_keys,
)

__all__ = [
    "accepted_details",
    "jdbc_options",
    "lookup_details",
    "probe_jdbc",
    "read_csv",
    "read_json_records",
    "read_json_union",
    "read_jdbc",
    "read_parquet",
    "records_by_union",
    "search_hits",
    "union_of_keys",
]
