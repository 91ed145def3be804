"""Incremental forms of the monthly counts and of de-duplication."""
