"""Readers, writers and the stored index tables."""
