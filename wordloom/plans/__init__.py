"""Whole jobs: these write intermediate tables and look at their size."""
