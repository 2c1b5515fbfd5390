"""Readers and connector options."""
