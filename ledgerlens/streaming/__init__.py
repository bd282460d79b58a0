"""Structured Streaming forms of selected rules and the alert sink."""
