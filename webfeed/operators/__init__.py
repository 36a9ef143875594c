"""Checks and reports over deliveries: validation, gaps, schema drift."""
