"""Refresh of documents when new review files arrive."""
