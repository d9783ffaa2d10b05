"""Operators of a training-data pipeline over texts, urls, vectors and conversations."""
