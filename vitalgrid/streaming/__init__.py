"""Incremental loading of landed files into keyed tables."""
