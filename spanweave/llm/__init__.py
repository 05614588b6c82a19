"""Operators for building training data from large text corpora.  Nothing else in the library imports this package."""
