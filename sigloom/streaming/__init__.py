"""Incremental processing: keyed state over streams."""
