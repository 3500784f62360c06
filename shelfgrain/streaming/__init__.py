"""Incremental pickup of landed files."""
