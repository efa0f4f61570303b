"""A PySpark-native engine for curating, searching and measuring large text collections."""
