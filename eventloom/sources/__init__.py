"""Scans and sinks of manifests, inventories, metadata and chips."""
