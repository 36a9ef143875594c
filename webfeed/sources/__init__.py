"""Scans: manifests, archive members, headers, hit tables and lookups."""
