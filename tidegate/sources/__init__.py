"""Readers for landed files."""
