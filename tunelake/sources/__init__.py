"""Readers, writers, the dataset manifest and the zone layout."""
