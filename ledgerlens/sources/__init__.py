"""Readers and writers for transactions, alerts, reports and models."""
