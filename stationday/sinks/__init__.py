"""Sinks: verified Parquet, GeoJSON and JSON documents, run metrics."""
