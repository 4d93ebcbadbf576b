"""Operators for preparing training text: duplicates, leaks, quality, languages, licences and tokens."""
