"""Scans, schemas and readers of run summaries."""
