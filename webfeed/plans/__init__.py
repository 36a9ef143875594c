"""Scan plan of a feed read (which files, which column order)."""
