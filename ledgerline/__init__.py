"""Spark-native analytics for business transactions (ERP tables to facts, dimensions and metrics)."""
