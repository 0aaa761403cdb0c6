"""Structured Streaming jobs and the batch writers they share."""
