"""Operators for text corpora on their way to training data. Nothing else in the library imports this package."""
