"""Readers, writers and the incremental store."""
