"""Operators for large text, vector and conversation tables, and their queries."""
