"""Spark-native analytics for cumulative energy meters and hourly weather."""
