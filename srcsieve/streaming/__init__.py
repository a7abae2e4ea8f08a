"""Structured Streaming forms of discovery and curation."""
