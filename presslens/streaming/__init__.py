"""Structured Streaming jobs: payload decoding, scored keyed sink, per-source
late-data cutoffs."""
