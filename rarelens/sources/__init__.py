"""Readers, sinks and config records."""
