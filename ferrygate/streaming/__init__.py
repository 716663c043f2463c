"""Structured Streaming forms of the landing load and the scan alarm."""
