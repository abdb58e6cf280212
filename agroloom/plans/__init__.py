"""Composites: section bundles, export tables and fixed-width output."""
