"""Readers, writers and row generators."""
