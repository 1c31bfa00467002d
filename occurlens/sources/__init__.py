"""Readers: the fixture raw table and the multi-file occurrence source."""
