"""Scans: feeds, documents, requirement sets, state, configuration."""
