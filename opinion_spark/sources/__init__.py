"""Readers, writers, inline dimensions and bindings to the driver tables."""
