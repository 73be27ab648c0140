"""Smoothed next-word tables from n-gram counts, as Spark DataFrame jobs."""
