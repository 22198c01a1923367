"""Readers, writers and test tables."""
