"""Scans with their contracts, rulebooks, and sinks."""
