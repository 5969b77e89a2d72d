"""Spark-first curation of interaction traces and training text."""
