"""Whole queries built from the library's operators."""
