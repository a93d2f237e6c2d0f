"""PySpark-native analytics over infrastructure-monitoring data."""
