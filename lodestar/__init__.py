"""lodestar: the reference's data jobs expressed as Spark DataFrame, SQL, ML
and Structured Streaming programs."""

__version__ = "0.1.0"
