"""Spark-native retail KPI analytics."""
