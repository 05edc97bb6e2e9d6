"""Scans of transactions and events."""
