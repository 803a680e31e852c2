"""Retail metrics as PySpark DataFrames: land, clean, load a star schema, report."""

from tillmetrics.settings import RETAIL, Settings

__all__ = ["RETAIL", "Settings"]
