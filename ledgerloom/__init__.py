"""Ledgerloom: governed document-dataset operations as declarative Spark plans."""

__version__ = "0.1.0"
