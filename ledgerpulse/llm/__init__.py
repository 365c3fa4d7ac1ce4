"""Operators of a training-data pipeline: ten methods, their queries and the SQL of those that have any."""
