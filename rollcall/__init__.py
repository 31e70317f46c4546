"""Workforce analytics on Spark DataFrames: typed HR tables, data quality, and workforce metrics."""

from rollcall.sources.tables import Workforce

__all__ = ["Workforce"]
