"""Telemetry operators: functions from DataFrames to DataFrames."""
