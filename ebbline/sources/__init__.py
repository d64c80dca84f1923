"""Readers that all yield the same two columns: ``value`` and ``arrival``."""
