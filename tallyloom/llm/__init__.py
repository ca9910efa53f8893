"""Operators for building training data from large text corpora; nothing else in the library imports them."""
