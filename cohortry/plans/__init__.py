"""Composition of the operators: which dataset feeds which, and what is written in between."""
