"""Tidemark: incremental record exchange as Spark jobs.

Extracts come in, whole-tuple records come out, and a master keeps the high
water mark of everything ever seen.  Every operator is a DataFrame in and a
DataFrame out; nothing here evaluates rows in Python.
"""

__version__ = "0.1.0"
