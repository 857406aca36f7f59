"""Readers, payload flatteners and sinks."""
