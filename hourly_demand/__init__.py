"""Hourly demand analytics on Spark DataFrames."""
