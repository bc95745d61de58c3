"""Spark-native operators for sensor series, forecast grids and point events."""
