"""Siftline: staged selection, scoring and ranking of large tables on PySpark."""
