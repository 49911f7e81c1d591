from tidemark.sources.csv import MALFORMED, MalformedRows, read_csv, read_csv_loose, stream_csv
from tidemark.sources.history import read_history, stored_columns

__all__ = [
    "MALFORMED", "MalformedRows", "read_csv", "read_csv_loose", "read_history", "stored_columns", "stream_csv",
]
