"""Profiles, keys, edges, hierarchies, reconciliation, assertions."""
