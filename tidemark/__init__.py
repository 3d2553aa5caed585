"""Tidemark: incremental sync, shaping and reconciliation of tables on Spark."""
