"""Replication, enrichment and reconciliation of time-stamped event logs on Spark."""
