"""Readers: every one has an explicit schema and, for ordered text, an ``_ord`` column."""
