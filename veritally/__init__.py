"""Spark-native analytics over problems, sampled completions and token log-probabilities."""
