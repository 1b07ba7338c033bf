"""Readers, record validation and writers."""
