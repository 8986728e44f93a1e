"""Operators: functions from DataFrame to DataFrame, lazy unless they write."""
