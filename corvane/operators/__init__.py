"""Operators: functions from DataFrames to DataFrames, for many queries at once and with explicit ranks."""
