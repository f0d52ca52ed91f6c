"""Operators for large training corpora of text; nothing else in the library imports them."""
