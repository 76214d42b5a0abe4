"""Readers, rule tables, seeds, writers and the test-data adapters."""
