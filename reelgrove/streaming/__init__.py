"""Structured Streaming jobs; each run drains its input and stops."""
