"""Subpackage of sparksift."""
