"""Operators for text corpora and for names without keys; nothing else in the library imports this package."""
