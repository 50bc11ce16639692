"""Readers and writers: files, landed payloads, stored statistics, run log."""
