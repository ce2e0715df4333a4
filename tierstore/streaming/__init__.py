"""File pickup with Structured Streaming."""
