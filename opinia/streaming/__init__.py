"""Scoring texts as they arrive."""
