"""Readers and ingest: nested JSON documents, delimited text."""
