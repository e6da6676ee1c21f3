"""Whole loads, layered tables and reports."""
