"""Continuous capture and replay."""
