"""Operators for training data made of offers and texts. Nothing else in the library imports this package."""
