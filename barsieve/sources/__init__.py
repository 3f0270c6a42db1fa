"""Readers and writers: CSV folders, binary snapshots, zip archives, metadata, tables."""
