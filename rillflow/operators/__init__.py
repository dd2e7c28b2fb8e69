"""Operators: functions that take and return DataFrames, with column names as arguments."""
