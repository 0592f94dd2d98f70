"""Structured Streaming into tables."""
