"""Scans, payload parsers and ingest rules."""
