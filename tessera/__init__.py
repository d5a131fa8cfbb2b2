"""A PySpark-native engine for point-in-time panel research."""
