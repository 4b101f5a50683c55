"""Readers, writers and versioned snapshots."""
