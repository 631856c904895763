"""Structured Streaming jobs over event envelopes."""
