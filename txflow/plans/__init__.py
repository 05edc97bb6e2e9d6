"""Whole jobs and the catalogue of queries."""
