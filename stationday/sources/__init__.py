"""Scans: landed payloads, raw CSV and JSON, the published table."""
