"""Load DataFrames into warehouse tables: convert strictly, write staged, register."""

from dockhand.errors import CommitError, ConflictError, LoadError, RejectLimitError, SpecError
from dockhand.operators.convert import clean_rows, dirty_rows, dirty_summary, project
from dockhand.operators.text import flag_hazards, render_lines
from dockhand.plans.load import LoadResult, load, recover, write_files
from dockhand.plans.parquet_text import parse_parquet_schema
from dockhand.plans.spec import Column, LoadSpec, PartitionColumn
from dockhand.plans.types import parquet_schema_from_columns, schema_from_columns
from dockhand.sources.files import list_files, list_group
from dockhand.sources.text import parse_lines, read_text

__all__ = [
    "Column", "CommitError", "ConflictError", "LoadError", "LoadResult", "LoadSpec",
    "PartitionColumn", "RejectLimitError", "SpecError", "clean_rows", "dirty_rows", "dirty_summary",
    "flag_hazards", "list_files", "list_group", "load", "parquet_schema_from_columns",
    "parse_lines", "parse_parquet_schema", "project", "read_text", "recover", "render_lines", "schema_from_columns", "write_files",
]
