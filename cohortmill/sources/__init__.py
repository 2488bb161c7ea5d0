"""Where tables are read from and written to."""

from .buckets import BucketedTable
from .files import FileSource, read_table
from .jdbc import JdbcSource
from .sink import JdbcSink
from .store import Batch, TableStore

__all__ = ["Batch", "BucketedTable", "FileSource", "JdbcSink", "JdbcSource", "TableStore", "read_table"]
