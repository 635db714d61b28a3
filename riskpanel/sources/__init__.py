"""Readers, writers and the bindings of the driver's test tables."""
