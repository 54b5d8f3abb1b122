"""Incremental loads: by high-water mark in batch, and by file stream."""
