"""vectable: analytics on tables of numeric feature vectors, as Spark DataFrame jobs.

A feature table has one row per point: an id column and an ``ARRAY<DOUBLE>``
column.  Operators take DataFrames and return DataFrames; fitted models are
small driver-side records that are sent to the tasks when scoring.
"""

__all__ = ["functions", "operators", "plans", "sources", "streaming"]
