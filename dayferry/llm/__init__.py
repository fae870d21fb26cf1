"""Operators of a training-data pipeline, each by a named method; nothing outside imports them."""
