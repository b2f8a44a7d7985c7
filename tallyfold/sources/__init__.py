"""Readers, writers and adapters that produce the logical tables."""
