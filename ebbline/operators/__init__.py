"""Batch transforms; those that need no order also run on streams."""
