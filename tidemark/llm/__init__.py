"""Operators for large-scale text corpora; nothing outside this subpackage imports it."""
