"""Composite jobs (JOB-01..12) and their bindings to the driver tables."""
