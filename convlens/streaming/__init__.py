"""Structured Streaming forms of ingest, rollup, monitoring and alerting."""
