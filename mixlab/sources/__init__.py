"""Scans, sinks and the views over the provided tables."""
