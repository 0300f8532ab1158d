"""Spark-native engine for auditing, shaping and checking document corpora."""
