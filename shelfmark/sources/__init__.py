"""Readers that turn files into records, and writers for submissions."""
