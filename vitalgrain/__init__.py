"""Profiling, rules and record validation for health-record tables on Spark."""
