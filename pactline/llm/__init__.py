"""Operators that prepare training data for language models.

Nothing else in the library imports this subpackage.  Each module holds one
operator: a function from DataFrame to DataFrame plus the small per-row or
per-block helpers that run inside Spark tasks.
"""
