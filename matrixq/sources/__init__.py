"""Readers and writers of matrix files and tables."""
