"""The pipeline as Structured Streaming queries."""
