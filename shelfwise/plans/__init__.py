"""Queries built from the operators, with their inputs, settings and report."""
