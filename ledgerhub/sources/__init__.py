"""Readers for landed files and registered tables."""
