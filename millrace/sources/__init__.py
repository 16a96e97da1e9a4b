"""Readers, writers, catalog helpers and small file-system helpers."""
