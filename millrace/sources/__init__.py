"""Scans: message lines and tables."""
