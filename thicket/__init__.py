"""Spark-native pixel time-series analytics."""
