"""Scans and sinks: raw zone, bronze tables, extracts, dead letters."""
