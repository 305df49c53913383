"""Table schemas, readers, writers and the frames derived from the event table."""
