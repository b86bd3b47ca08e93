"""Readers, writers, table maintenance and declared schemas."""
