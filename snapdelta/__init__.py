"""Snapshot and change-detection analytics on Spark DataFrames.

Operators take DataFrames and plain parameters and return DataFrames built from
Spark expressions. Reference dates and "as of" times are always arguments.
"""

__version__ = "0.1.0"
