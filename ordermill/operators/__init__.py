"""Operators: functions from DataFrames to DataFrames, plus the writers and gates around them."""
