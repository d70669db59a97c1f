"""Spark-native preparation, auditing and classification of labelled text tables."""

__version__ = "0.1.0"
