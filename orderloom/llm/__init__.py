"""Operators of a training-data pipeline over documents and pages. Nothing else in the library imports this package."""
