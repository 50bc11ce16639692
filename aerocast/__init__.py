"""Spark-native forecasting and monitoring of hourly air-quality readings."""
