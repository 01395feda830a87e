"""Operators on text corpora for building training data. Nothing else in the library imports this package."""
