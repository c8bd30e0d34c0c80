"""Operators of a training-data pipeline (corpus cleaning and encoding)."""
