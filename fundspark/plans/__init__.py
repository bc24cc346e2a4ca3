"""Whole runs: compositions of operators."""
