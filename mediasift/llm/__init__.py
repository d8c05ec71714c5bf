"""Operators of a training-data pipeline over raw text. Nothing outside imports this package."""
