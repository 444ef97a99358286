"""evenfall: a Spark-first engine for event records taken from web pages."""

__version__ = "0.1.0"
