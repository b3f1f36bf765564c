"""Readers for ticket exports, key configs, view files and table schemas."""
