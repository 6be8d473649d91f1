"""Spark-native analytics for industrial sensor readings."""
