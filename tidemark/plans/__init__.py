from tidemark.plans.bronze import with_load_columns
from tidemark.plans.ingest import IngestResult, SchemaMismatch, conform, ingest
from tidemark.plans.silver import Field, clean, ignored_values, split_rejects

__all__ = [
    "Field", "IngestResult", "SchemaMismatch", "clean", "conform", "ignored_values", "ingest",
    "split_rejects", "with_load_columns",
]
