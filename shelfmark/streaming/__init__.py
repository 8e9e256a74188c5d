"""Scoring of record streams."""
