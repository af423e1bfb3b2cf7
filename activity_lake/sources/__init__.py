"""Readers, batch and streaming."""
