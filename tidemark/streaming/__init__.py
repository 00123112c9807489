"""Streaming jobs, their stateful operator and their sinks."""
