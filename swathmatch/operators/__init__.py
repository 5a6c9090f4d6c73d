"""Joins, aggregations and table operations, ``DataFrame -> DataFrame``."""
