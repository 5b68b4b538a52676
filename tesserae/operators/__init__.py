"""Lazy ``DataFrame -> DataFrame`` operators."""
