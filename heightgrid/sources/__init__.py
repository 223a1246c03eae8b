"""Readers, writers, run registry and output listings."""
