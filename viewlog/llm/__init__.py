"""Operators that prepare text, pages and vectors for training a language model."""
