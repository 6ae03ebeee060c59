"""Readers of raw files, and readers and writers of governed tables."""
