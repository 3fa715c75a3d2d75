"""Operators over pages, lines, blocks, sections, placeholders and nodes."""
