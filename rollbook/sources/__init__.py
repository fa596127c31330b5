"""Landed pages, academy config and stored tables."""
