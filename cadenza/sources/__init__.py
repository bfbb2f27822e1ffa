"""Readers and writers for the delimited, JSON and text files."""
