"""A Spark-native lake for payment events."""
