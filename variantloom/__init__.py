"""Spark-native annotation and curation of short variants across sequencing cohorts."""

__version__ = "0.1.0"
