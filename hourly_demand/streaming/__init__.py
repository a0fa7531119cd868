"""Structured Streaming jobs on trips."""
