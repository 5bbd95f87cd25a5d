"""Spark-native lead enrichment, data quality and corpus preparation."""
