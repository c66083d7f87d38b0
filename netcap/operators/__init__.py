"""Relational operators over capital events and the position state."""
