"""Retail transaction analytics on Spark DataFrames."""
