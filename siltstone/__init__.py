"""Versioned columnar tables on PySpark."""

from siltstone.errors import CommitConflict, TableNotFound, UnsupportedType
from siltstone.namespace import DirectoryNamespace, connect, register_namespace
from siltstone.operators.compact import CompactionMetrics, compact_files
from siltstone.operators.evolve import BatchUDF, add_columns
from siltstone.operators.fragments import FragmentCommitter, FragmentWriter
from siltstone.operators.index import IndexConfig, create_scalar_index
from siltstone.operators.write import write_table
from siltstone.plans.layout import CompactionOptions
from siltstone.sources.scan import read_table
from siltstone.table import Table, open_table

__all__ = [
    "BatchUDF",
    "CommitConflict",
    "CompactionMetrics",
    "CompactionOptions",
    "DirectoryNamespace",
    "FragmentCommitter",
    "FragmentWriter",
    "IndexConfig",
    "Table",
    "TableNotFound",
    "UnsupportedType",
    "add_columns",
    "compact_files",
    "connect",
    "create_scalar_index",
    "open_table",
    "read_table",
    "register_namespace",
    "write_table",
]
