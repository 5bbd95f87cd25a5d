"""Subpackage sources."""
