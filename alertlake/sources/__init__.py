"""Readers: every one returns a lazy DataFrame in the flat alert schema."""
