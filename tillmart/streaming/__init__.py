"""Continuous payload intake with Structured Streaming."""
