"""Served queries and multi-step loads composed from the operators."""
