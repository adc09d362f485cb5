"""Readers, sinks and catalog tables."""
