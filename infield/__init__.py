"""A Spark-native analytics engine for event-level sports data."""
