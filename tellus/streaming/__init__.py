"""Structured Streaming: topic -> raw JSONL lake, stream dedup, volumes."""
