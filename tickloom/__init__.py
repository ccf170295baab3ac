"""A PySpark-native engine for tick-data analytics."""
