"""Continuous loading of landed pages."""
