"""Readers, payload extraction, block records, endpoints and table sinks."""
