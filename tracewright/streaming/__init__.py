"""Capture and sessions as streams."""
