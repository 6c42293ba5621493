"""Operators: functions from DataFrames to DataFrames with explicit keys and tie-breaks."""
