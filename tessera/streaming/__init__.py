"""Incremental fills of the lake."""
