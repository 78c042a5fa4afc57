"""Column builders and small helpers that run inside tasks."""
