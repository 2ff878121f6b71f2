"""Readers, writers and the adapter for the driver's star-schema tables."""
