"""Streaming form of the landing intake."""
