"""Skew rules and end-to-end plans."""
