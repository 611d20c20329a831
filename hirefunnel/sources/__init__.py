"""Readers for event logs, dimensions, fact tables and message streams."""
