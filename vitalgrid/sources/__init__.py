"""Scans: CSV files, landed API pages, file listings, tiles and keyed tables."""
