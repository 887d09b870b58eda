"""Scans: tables, files, JSON records and points."""
