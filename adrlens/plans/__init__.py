"""Queries over the test tables, their SQL counterparts, and end-to-end runs."""
