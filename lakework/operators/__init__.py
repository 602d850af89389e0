"""Relational and document operators, DataFrame to DataFrame."""
