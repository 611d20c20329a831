"""Whole jobs: batch, incremental, and the staged publication they share."""
