"""Readers with explicit schemas, keyword dictionaries and writers."""
