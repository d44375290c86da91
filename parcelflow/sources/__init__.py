"""Readers, sinks and the logistics feeds derived from the test tables."""
