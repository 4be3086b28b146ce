"""Jobs, the whole ingest run, and the event log."""
