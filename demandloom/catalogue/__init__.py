"""Registered queries over the test tables, and the plain SQL each is checked against."""
