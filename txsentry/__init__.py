"""txsentry: card-transaction fraud analytics on Spark DataFrames, SQL, MLlib and
Structured Streaming."""

__version__ = "0.1.0"
