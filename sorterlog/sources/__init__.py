"""Readers and writers. Every reader takes paths and returns a DataFrame of strings."""
