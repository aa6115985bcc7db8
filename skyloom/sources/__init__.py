"""Readers, writers and codecs."""
