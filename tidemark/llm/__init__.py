"""Operators for preparing text and vectors as training data."""
