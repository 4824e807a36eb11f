"""Readers and writers for the file shapes the analysis uses."""
