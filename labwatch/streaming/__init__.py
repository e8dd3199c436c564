"""Streams of arriving files."""
