"""File-discovery ingest."""
