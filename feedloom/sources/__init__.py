"""Readers and writers: feed directories, tables, slices, answer keys."""
