"""Relational operators of replication, reconciliation and retention."""
