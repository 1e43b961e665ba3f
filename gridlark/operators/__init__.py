"""Statements that change tables."""
