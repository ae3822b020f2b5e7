"""Readers: typed file scans, landing-zone discovery and cube decoding."""
