"""Readers. Schemas are given, never inferred."""
