"""Readers and writers of snapshot files, change files, state and features."""
