"""Scoring and deduplicating calls as they arrive."""
