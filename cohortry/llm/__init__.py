"""Operators for large text corpora, each built by its own method; nothing else in the library imports them."""
