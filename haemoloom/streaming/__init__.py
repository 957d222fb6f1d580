"""Bins and sessions of readings that arrive over time."""
