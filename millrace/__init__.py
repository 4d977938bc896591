"""millrace: a Spark-first engine that prepares multimodal training data."""

__version__ = "0.1.0"
