"""Operators wired together: the table build and the query catalog."""
