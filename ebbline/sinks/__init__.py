"""Idempotent upserts, batched key-value writers, text files and console."""
