"""Readers, writers, table maintenance and mirror jobs."""
