"""Composed plans: the checks, the test star schema, the query registry."""
