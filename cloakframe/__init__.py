"""A PySpark-native engine for privacy analytics over financial series and documents."""
