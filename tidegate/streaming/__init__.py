"""Receiving driven by a stream of landed files."""
