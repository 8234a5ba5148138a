"""Reusable DataFrame operators (no I/O, no fixed parameters)."""
