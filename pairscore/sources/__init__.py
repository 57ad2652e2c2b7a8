"""Scans, sinks and fixture views."""
