"""Electricity-meter telemetry on Spark: rules, windows, envelopes, reports and streams."""
