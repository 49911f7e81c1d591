from tidemark.operators.dedupe import dedupe
from tidemark.operators.describe import describe
from tidemark.operators.newrows import KeyProfile, new_rows, profile_keys, unstored_rows
from tidemark.operators.clustering import append_clustered
from tidemark.operators.profile import (
    column_info, head, head_in_file_order, null_counts, top_values, value_counts, value_counts_multi,
)
from tidemark.operators.sinks import append, overwrite

__all__ = [
    "KeyProfile", "append", "append_clustered", "column_info", "dedupe", "describe", "head", "head_in_file_order", "new_rows",
    "null_counts", "overwrite", "profile_keys", "top_values", "unstored_rows", "value_counts", "value_counts_multi",
]
