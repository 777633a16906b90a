"""Structured Streaming monitors and their batch twins."""
