"""Readers, writers and partition maintenance."""
