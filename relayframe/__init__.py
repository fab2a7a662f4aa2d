"""Change-data pipelines over tables, message logs and archives, on Spark DataFrames."""

__version__ = "0.1.0"
