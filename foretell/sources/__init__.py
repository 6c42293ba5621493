"""Readers and writers: catalog tables, CSV extracts, vocabularies, group sets."""
