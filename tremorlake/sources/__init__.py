"""Readers and writers for landed feeds, snapshots and tables."""
