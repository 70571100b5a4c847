"""File-stream ingestion built on Structured Streaming."""
