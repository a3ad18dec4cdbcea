"""Operators for preparing text as training data; nothing else in derlem imports this."""
