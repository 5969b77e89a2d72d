"""Operators on traffic and traces, each a function from DataFrame to DataFrame."""
