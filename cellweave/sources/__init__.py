"""Sinks, and readers of what they write."""
