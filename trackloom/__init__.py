"""A PySpark-native engine for structured person-object interaction data."""
