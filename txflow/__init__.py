"""Retail transaction analytics on Spark: cleaning, features, summaries and event windows."""
