"""Typed ingest and reconciliation of warehouse tables on Spark."""
