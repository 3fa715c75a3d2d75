"""Whole-document text functions as column expressions."""
