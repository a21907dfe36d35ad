"""Vital-sign time-series analytics on Spark DataFrames and Structured Streaming."""
