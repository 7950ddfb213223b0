"""Helpers that shape plans: lineage cuts and table access."""
