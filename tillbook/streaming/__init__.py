"""Structured Streaming counterparts of the batch loads."""
