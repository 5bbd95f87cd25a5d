"""Subpackage operators."""
