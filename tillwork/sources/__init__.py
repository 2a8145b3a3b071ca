"""Readers, writers, landed and versioned tables."""
