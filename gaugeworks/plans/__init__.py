"""Registered query plans over the provided tables and their SQL oracles."""
