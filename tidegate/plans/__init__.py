"""Reusable plan shapes: key look-ups, ordered numbering, pattern joins."""
