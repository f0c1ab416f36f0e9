"""Operators over DataFrames: what crosses rows, pages or tables."""
