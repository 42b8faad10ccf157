"""A Spark-native engine for signal intelligence: scoring, event clustering, gating, observability."""
