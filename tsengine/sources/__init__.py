"""Landed feeds, the versioned series store and the metadata tables."""
