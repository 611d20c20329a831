"""Hourly recruitment-funnel metrics on Spark: batch, incremental and streaming."""
