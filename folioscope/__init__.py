"""Spark-native evidence analytics: records, spans, claims, accounts, grading and corpus health as DataFrames."""
