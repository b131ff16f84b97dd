"""imagelake: image-classification data work as Spark DataFrame, SQL,
Structured Streaming and Spark ML jobs (see README.md)."""

__version__ = "0.1.0"
