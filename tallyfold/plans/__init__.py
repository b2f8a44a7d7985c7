"""Registered queries with their SQL checks, and the multi-stage jobs."""
