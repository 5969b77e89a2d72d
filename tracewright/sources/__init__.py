"""Readers and writers of traffic and traces."""
