"""Subpackage functions."""
