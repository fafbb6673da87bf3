"""Readers and writers: CSV, Parquet, and the manifest of landed files."""

from wardframe.sources.bronze import manifest
from wardframe.sources.bucketed import join_stored, read_stored, store_for_join
from wardframe.sources.delimited import (
    MISSING_TOKENS,
    duplicate_headers,
    header_names,
    read_csv,
    read_csv_inferred,
    sweep_csv,
    sweep_heads,
)
from wardframe.sources.inference import infer_types
from wardframe.sources.listing import list_files
from wardframe.sources.records import records
from wardframe.sources.tables import join_path, read_parts, read_table, write_table
from wardframe.sources.versions import ConflictError, Publication, Store, remove_unpublished

__all__ = [
    "MISSING_TOKENS",
    "ConflictError",
    "Publication",
    "Store",
    "duplicate_headers",
    "header_names",
    "infer_types",
    "join_path",
    "join_stored",
    "list_files",
    "manifest",
    "read_csv",
    "read_csv_inferred",
    "read_parts",
    "read_stored",
    "read_table",
    "records",
    "remove_unpublished",
    "store_for_join",
    "sweep_csv",
    "sweep_heads",
    "write_table",
]
