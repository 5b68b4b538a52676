"""Queries built from the operators, with their reference SQL."""
