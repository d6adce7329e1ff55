"""Structured Streaming forms of the ad-log analyses."""
