"""Readers and writers of tables, payloads, pages and lines."""
