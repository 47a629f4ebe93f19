"""Marketing-mix analytics on Spark DataFrames, from transactions to a budget."""

__version__ = "0.1.0"
