"""Queries run over the test data, and the SQL each one is checked against."""
