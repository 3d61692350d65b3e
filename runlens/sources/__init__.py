"""Readers and writers of the text, CSV and JSON files."""
