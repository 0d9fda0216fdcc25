"""Reusable relational pieces built from DataFrame operations."""
