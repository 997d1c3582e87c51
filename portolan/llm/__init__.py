"""Operators for building training data from web-scale text."""
