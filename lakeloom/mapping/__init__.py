"""Declarative event mappings compiled to one select per event type."""
