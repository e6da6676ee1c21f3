"""Operators over frames: cleansing, checks, row decisions and table states."""
