"""Readers, writers, fixed schemas and fixture views."""
