"""Retail tables derived from the test star schema, and what they should come to in SQL."""
