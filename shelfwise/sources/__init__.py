"""Readers and writers: text, tables, streams and snapshot tables."""
