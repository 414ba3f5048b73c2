"""Operators for preparing training data: deduplication, joins on
similarity, scoring, tokenising, mixing. Nothing else in the library
imports this package."""
