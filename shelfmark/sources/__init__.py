"""Readers, writers and row previews."""
