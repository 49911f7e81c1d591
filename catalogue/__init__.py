"""The registered queries, each next to the SQL that gives the same rows."""

from catalogue import ingestion, layers, profiling

ENTRIES = {**ingestion.ENTRIES, **profiling.ENTRIES, **layers.ENTRIES}
