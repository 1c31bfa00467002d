"""Operators for large-scale training-data pipelines (text corpora).

Nothing outside this subpackage imports it; ``queries.py`` holds the
registered queries and their oracle SQL.
"""
