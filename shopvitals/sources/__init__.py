"""Readers for raw tables, message topics and test fixtures."""
