"""Readers and writers for landed data."""
