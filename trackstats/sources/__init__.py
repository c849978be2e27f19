"""Readers, writers and extraction of rows from stored pages and responses."""
