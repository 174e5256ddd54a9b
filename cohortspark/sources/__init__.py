"""Reading, checking and writing tables."""

from cohortspark.sources.contracts import (
    CONTRACTS,
    SchemaError,
    missing_columns,
    require_schema,
    unsuitable_columns,
)
from cohortspark.sources.publish import Publication, read_manifest, recover
from cohortspark.sources.scratch import Scratch
from cohortspark.sources.tables import read_table, read_tables, write_table

__all__ = [
    "CONTRACTS",
    "Publication",
    "SchemaError",
    "Scratch",
    "missing_columns",
    "read_manifest",
    "read_table",
    "read_tables",
    "recover",
    "require_schema",
    "unsuitable_columns",
    "write_table",
]
