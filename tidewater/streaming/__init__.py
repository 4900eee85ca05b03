"""Structured Streaming jobs: ingest (message stream -> lake + serving table) and the
paced producer."""
