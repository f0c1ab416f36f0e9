"""Foliograph: document analytics on PySpark.

Pages of documents become tables, charts and ordered, retrieval-ready text
chunks. One row is one page; everything inside a page is worked out with
built-in column functions on that row, and only work that crosses pages
shuffles.
"""

__version__ = "0.1.0"
