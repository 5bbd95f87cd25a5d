"""Subpackage streaming."""
