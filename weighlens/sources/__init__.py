"""Scans and lookup tables."""
