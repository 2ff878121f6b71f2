"""Cleaning and sessions over arriving events."""
