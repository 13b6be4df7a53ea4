"""End-to-end jobs composed from ``tellus.operators``."""
