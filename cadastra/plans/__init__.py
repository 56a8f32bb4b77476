"""Whole-history replay and the one-day step."""
