"""Readers, writers, landing folders and feed payload parsers."""
