"""Readers of landed data and writers of result tables."""
