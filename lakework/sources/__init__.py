"""Readers, writers, sidecars and transport."""
