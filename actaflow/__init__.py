"""Personnel-act analytics on PySpark: extraction, deduplication, timelines, analysis."""

__version__ = "0.1.0"
