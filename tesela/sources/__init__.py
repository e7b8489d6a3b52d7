"""Readers, writers and bookkeeping of file sources."""
