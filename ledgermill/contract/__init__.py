"""Registered queries: banking fixtures derived from the test tables, and their SQL oracles."""
