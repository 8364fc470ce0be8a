"""Readers, writers and physical layout."""
