"""Structured Streaming forms (T1-T4) and the posted-requests stream."""
