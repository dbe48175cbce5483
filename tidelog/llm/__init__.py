"""Operators on the text corpus. Nothing outside this package imports it."""
