"""Time-series analytics over hourly station readings, written for Spark.

Every operator takes and returns DataFrames. The canonical frame is
``(series STRING, ts TIMESTAMP_NTZ, value DOUBLE)`` with at most one row per
series and hour.
"""
