"""Readers, writers and the versioned silver tables."""
