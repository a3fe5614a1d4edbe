"""Readers, writers and the warehouse."""
