"""Operators for large-scale training data; nothing outside this folder imports them."""
