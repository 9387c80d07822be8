"""Readers for delimited inputs, exported results and keyed tables."""

from tastegrid.sources.delimited import (
    read_delimited,
    read_items,
    read_ratings,
    read_users,
    split_bad_lines,
    with_input_order,
)
from tastegrid.sources.stored import (
    files_below,
    manifest_path,
    path_exists,
    read_documents,
    read_export,
    read_first_available,
    read_ids,
    read_keyed,
    read_manifest,
    read_table,
)
from tastegrid.sources.vocabulary import outside_vocabulary, vocabulary

__all__ = [
    "files_below",
    "manifest_path",
    "outside_vocabulary",
    "path_exists",
    "read_delimited",
    "read_documents",
    "read_export",
    "read_first_available",
    "read_ids",
    "read_items",
    "read_keyed",
    "read_manifest",
    "read_ratings",
    "read_table",
    "read_users",
    "split_bad_lines",
    "vocabulary",
    "with_input_order",
]
