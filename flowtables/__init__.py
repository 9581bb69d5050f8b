"""Change-stream and event-stream analytics as plain PySpark jobs."""

__version__ = "0.1.0"
