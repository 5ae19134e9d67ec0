"""tidemark: change-data and table-quality operators for Spark.

Every operator is a function from DataFrames to a DataFrame (or a stream
runner built on Structured Streaming); see README.md for the map of modules.
"""

__version__ = "0.1.0"
