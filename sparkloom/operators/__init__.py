"""Analyses over tables; see also ``operators.graph``."""
