"""PySpark-native data-integration and analytics engine."""
