"""Readers, header repair, dimensions, writers and releases."""
