"""Scalar functions over columns: URLs and ids, text cleaning, quality checks."""
