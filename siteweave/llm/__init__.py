"""Operators on free text, names, addresses and matches between records."""
