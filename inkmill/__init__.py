"""Spark-native preparation of scored text corpora."""
