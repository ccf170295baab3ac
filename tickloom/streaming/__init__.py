"""Bars from quotes that keep arriving."""
