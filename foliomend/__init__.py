"""Repair, restructure and prepare large sets of OCR Markdown documents on Spark."""
