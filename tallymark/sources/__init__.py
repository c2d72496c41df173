"""Readers, fixed schemas and sinks."""
