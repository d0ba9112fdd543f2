"""faultweave: incident analytics and training-data preparation on Spark.

Everything is declared on DataFrames; Python code runs only in Arrow batches and only where
Spark has no expression for the semantics (recursive JSON, run-length partial states).
"""

__version__ = "0.1.0"
