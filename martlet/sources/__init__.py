"""Readers, writers and the canonical retail tables."""
