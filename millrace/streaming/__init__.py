"""Windowed counts and trends, on tables and on streams alike."""
