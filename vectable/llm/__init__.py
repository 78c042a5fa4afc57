"""Operators for building training data from text and vectors, their queries and SQL."""
