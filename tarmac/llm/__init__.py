"""Operators on training text: licences, mixing, quality, duplicates, secrets, tokens."""
