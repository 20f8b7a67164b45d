"""A PySpark-native engine for gridded daily weather."""
