"""Sources: driver tables, JSON/JSONL files, sitemaps, raw pages, Kafka payloads."""
