"""Customer retention, decision lookup and moist-air analytics as PySpark table operators."""

__version__ = "0.1.0"
