"""Readers for numeric text and model tables."""
