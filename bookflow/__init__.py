"""Spark-native reservation analytics: normalise, stage, merge, report."""

__version__ = "0.1.0"
