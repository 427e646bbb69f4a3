"""Structured Streaming entry points (the fix-status merge on arriving changelog files)."""
