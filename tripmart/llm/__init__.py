"""Operators for preparing text corpora; each module is one operator with its own options."""
