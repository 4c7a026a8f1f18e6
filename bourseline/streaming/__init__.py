"""Incremental intake of landed files."""
