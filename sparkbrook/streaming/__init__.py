from sparkbrook.streaming.ingest import BatchReport, Ingest, console, run_stream

__all__ = ["BatchReport", "Ingest", "console", "run_stream"]
