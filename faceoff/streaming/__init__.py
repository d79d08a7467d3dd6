"""Structured Streaming form of refresh: documents arriving in a landing folder."""
