"""Composite models, their binding to the test tables, and the SQL they are checked against."""
