"""Read-only access to table-format snapshots: table directories become ordinary Spark DataFrames."""

from .errors import InvalidInputError, LakeError, NotSupportedError, TableIOError
from .functions.tables import metadata, register, scan, snapshots, sql, table_plan

__version__ = "0.1.0"
__all__ = ["InvalidInputError", "LakeError", "NotSupportedError", "TableIOError", "metadata", "register", "scan", "snapshots", "sql", "table_plan"]
