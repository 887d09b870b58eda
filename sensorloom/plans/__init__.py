"""Configured jobs built from the operators."""
