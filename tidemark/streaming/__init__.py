"""Structured Streaming: raw landing and the minute pulse."""
