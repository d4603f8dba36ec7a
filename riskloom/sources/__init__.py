"""Readers, sinks and the mapping from the given tables to transactions."""
