"""Operators for text and training data; nothing outside this package imports it."""
