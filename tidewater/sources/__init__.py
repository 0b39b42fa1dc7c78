"""Readers of landed extracts."""
