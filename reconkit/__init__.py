"""Spark-native table reconciliation and analysis."""
