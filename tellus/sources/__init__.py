"""Sources (feed envelopes, lake scans, tables, seed) and sinks."""
