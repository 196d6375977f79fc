"""Operators of a training-data pipeline, each with its registered query."""
