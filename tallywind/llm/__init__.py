"""Operators of a training-data pipeline: each cleans, scores or reshapes a corpus."""
