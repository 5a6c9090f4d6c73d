"""Readers and writers: tables in, tables out, always with a declared schema."""
