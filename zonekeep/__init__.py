"""Provenance-aware internet-name registries and bulk DNS results on Spark."""

__version__ = "0.1.0"
