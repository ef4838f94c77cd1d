"""Readers: raw files, layered tables and star-schema views."""
