"""Stages, file scans, listings and external tables."""
