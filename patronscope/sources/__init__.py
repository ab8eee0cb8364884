"""Readers, schema conformance, staging and sinks."""
