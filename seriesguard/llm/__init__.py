"""Operators for preparing language-model training data: mixing, search, extraction, joins, dedup, scoring.

Nothing else in the package imports this subpackage.
"""
