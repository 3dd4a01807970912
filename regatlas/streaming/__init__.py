"""Arriving block streams."""
