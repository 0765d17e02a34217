"""Readers, staging views and file sinks."""
