"""Structured Streaming versions of the application's row-at-a-time ingest,
5-minute polling and alerting."""
