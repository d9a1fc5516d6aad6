"""Spark-native analytics for turn-based dialogue corpora."""
