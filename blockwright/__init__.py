"""Spark-native block lakehouse: flatten, derive, check and query streams of nested block records."""
