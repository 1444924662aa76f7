from .files import malformed_by_file, read_csv, read_table, store_buckets, write_csv
from .schemas import CITY_SCHEMA, TRIP_SCHEMA
from .streams import stream_csv, stream_table
from .views import register, run_sql

__all__ = [
    "CITY_SCHEMA",
    "TRIP_SCHEMA",
    "malformed_by_file",
    "read_csv",
    "read_table",
    "register",
    "run_sql",
    "store_buckets",
    "stream_csv",
    "stream_table",
    "write_csv",
]
