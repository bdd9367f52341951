"""Readers, entity views and sinks."""
