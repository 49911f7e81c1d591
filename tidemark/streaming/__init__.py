from tidemark.streaming.daily import ingest_available

__all__ = ["ingest_available"]
