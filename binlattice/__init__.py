"""Binned-signal copy-number analytics on Spark."""
