"""The operators on Structured Streaming micro-batches."""
