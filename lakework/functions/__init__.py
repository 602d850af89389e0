"""Column builders: hashing, text, dates, enumerations, JSON."""
