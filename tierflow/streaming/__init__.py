from tierflow.streaming.ingest import drain, ingest_events

__all__ = ["drain", "ingest_events"]
