"""Where nested events come from and where flat rows go."""

from .files import file_sink, file_source, parquet_sink, parquet_source
from .tables import table_sink, table_source

__all__ = [
    "file_sink",
    "file_source",
    "parquet_sink",
    "parquet_source",
    "table_sink",
    "table_source",
]
