"""Readers and writers: tile archives, services and published files."""
