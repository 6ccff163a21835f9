"""Whole jobs, and the catalogue of queries checked against SQL."""
