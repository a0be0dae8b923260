"""Event-time analytics over long observation logs, on Spark DataFrames."""
