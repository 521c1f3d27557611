"""Readers, writers and feeds."""
