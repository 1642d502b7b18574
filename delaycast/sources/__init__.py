"""Readers for landed feeds, tables, topics and vocabularies."""
