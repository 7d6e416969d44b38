"""Continuous jobs."""
