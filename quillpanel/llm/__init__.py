"""Operators for language data and entity names; nothing else in the library imports this package."""
