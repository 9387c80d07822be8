"""Keyed tables, exports and stored results, all written by the executors."""

from tastegrid.sinks.cache import inputs_version, materialize_or_load
from tastegrid.sinks.manifest import key_ranges, merge_keyed, replace_keyed
from tastegrid.sinks.tables import (
    checksums,
    differences,
    keep_one_per_key,
    replace_table,
    swap_in,
    write_clustered,
    write_export,
)

__all__ = [
    "checksums",
    "differences",
    "inputs_version",
    "keep_one_per_key",
    "key_ranges",
    "materialize_or_load",
    "merge_keyed",
    "replace_keyed",
    "replace_table",
    "swap_in",
    "write_clustered",
    "write_export",
]
