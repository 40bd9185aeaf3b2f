"""Layers kept up to date by Structured Streaming."""
