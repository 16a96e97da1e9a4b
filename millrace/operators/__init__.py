"""Relational, feature-table and model-data operators."""
