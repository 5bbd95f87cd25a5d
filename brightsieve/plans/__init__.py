"""Subpackage plans."""
