"""Readers, writers and schema adapters."""
