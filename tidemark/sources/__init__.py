"""Readers and the shaping of raw records into messages."""
