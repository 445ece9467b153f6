"""Spark-native analytics over continuous-integration history.

Every operator takes DataFrames and returns a DataFrame; nothing is collected
to the driver and no Python row functions run in the hot path.
"""
