"""Registration analytics on Spark: nested orders in, declarative reports out."""

__version__ = "0.1.0"
