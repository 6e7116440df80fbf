"""Readers, sinks and test-table adapters."""
