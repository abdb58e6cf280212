"""Readers for landed files: CSV folders, XML, sensor JSON, soil horizons, section reports."""
