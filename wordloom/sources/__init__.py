"""Readers: every one returns a lazy DataFrame."""
