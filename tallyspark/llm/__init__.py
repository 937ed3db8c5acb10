"""Operators for training-data pipelines, their queries and the SQL these must equal.

Nothing else in the library imports this subpackage.
"""
