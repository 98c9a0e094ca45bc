"""Structured Streaming jobs: windowed tag trends and per-batch scoring."""
