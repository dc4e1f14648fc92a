"""Checked queries: the operators over the star-schema tables, and the same results in plain SQL."""
