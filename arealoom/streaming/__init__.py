"""Resumable staging of arriving files."""
