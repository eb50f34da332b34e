"""Operators for preparing training text: tokens, duplicates, search, scans, archives, mixing."""
