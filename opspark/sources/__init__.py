"""Readers, sinks and fixed dimensions."""
