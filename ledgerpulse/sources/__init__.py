"""Schemas, readers, writers, document hand-off and test-table adapters."""
