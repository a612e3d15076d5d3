"""Readers, writers, versioned tables and the run ledger."""
