"""gaugework: a Spark-native analytics engine for periodic event data."""
