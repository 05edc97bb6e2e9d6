"""Outputs."""
