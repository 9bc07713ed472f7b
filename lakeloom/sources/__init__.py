"""Readers: tables, envelopes, dead letters, landing files."""
