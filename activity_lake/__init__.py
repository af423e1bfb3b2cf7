"""Change-stream analytics on a bronze/silver lake, written with PySpark DataFrames and Structured Streaming."""

__version__ = "0.1.0"
