"""Incremental processing of folders."""
