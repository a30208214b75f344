"""Subscriber scoring on Spark: prepare, profile, train, score, stream, explain."""
