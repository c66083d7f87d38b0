"""Structured Streaming jobs: continuous position, log, changelog."""
