"""A Spark-native engine for record linkage: who in several noisy sources is the same entity."""
