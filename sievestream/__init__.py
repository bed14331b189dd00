"""sievestream: rule matching and message-stream enrichment on Spark DataFrames."""

__version__ = "0.1.0"
