"""Operators over scenes, pixels, tiles and points."""
