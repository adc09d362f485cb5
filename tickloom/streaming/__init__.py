"""The ingest job as a file stream."""
