"""Readers and writers: feed files, CSV tables, JSON documents, and the result store."""
