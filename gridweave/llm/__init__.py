"""Operators for text corpora and record linkage; nothing outside this package imports it."""
