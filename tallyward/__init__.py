"""Spark-native fraud analytics: raw loads, staging, features, scoring, star schema."""
