"""Scans, sinks and conversions."""
