"""Spark-native engine for building instruction data from a chunked text corpus."""
