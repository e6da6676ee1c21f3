"""Readers for incoming files."""
