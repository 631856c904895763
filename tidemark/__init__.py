"""Warehouse and stream-processing operators expressed as Spark DataFrames."""

__version__ = "0.1.0"
