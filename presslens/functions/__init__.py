"""Column -> Column functions: text, dates, bands, metrics, JSON."""
