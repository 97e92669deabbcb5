"""Readers and writers (file connectors)."""
