"""Column expressions: time buckets, bands, text keys, pixel arrays."""
