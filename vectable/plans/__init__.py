"""The registered queries and the SQL each is checked against."""

from vectable.plans.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
