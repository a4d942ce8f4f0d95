"""Operators of a large training-data pipeline, kept apart from the rest of the engine."""
