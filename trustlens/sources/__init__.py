"""Readers, writers, adapters and schema repair."""
