"""The engine's jobs: functions from DataFrames to DataFrames that sources and sinks are put around."""
