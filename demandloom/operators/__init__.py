"""Lazy ``DataFrame -> DataFrame`` operators with column names as arguments."""
