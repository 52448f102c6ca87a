"""Structured Streaming re-aims of the online paths (scoring, rate limiting)."""
