"""Structured extraction from notes: tools, backends, and the distributed loop."""
