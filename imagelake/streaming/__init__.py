"""Structured Streaming jobs: scoring stream, request completeness, sampled frames."""
