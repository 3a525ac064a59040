"""Spark-native record linkage and notice analytics."""
