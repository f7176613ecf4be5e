from .base import FrameSource, Source
from .jdbc import JdbcSource, jdbc_url
from .parquet import ParquetSource, read_parquet
from .tables import TableStore, run_sql

__all__ = [
    "FrameSource",
    "JdbcSource",
    "ParquetSource",
    "Source",
    "TableStore",
    "jdbc_url",
    "read_parquet",
    "run_sql",
]
