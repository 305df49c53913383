"""The registered queries, their SQL counterparts and the batch ingest cycle."""
