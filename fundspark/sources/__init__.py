"""Declared input schemas, readers and sinks."""
