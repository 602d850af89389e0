"""Training-data operators over whole document and page tables.

Every operator takes a DataFrame and returns a DataFrame; ``queries`` holds the
thin per-table queries that the driver runs.  Nothing outside this folder
imports it.
"""
