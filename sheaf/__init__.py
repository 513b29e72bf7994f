"""sheaf: a PySpark-native engine for document evidence tables."""
