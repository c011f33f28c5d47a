"""DataFrame-to-DataFrame operators: quality rules, stacking, pairing, keyed ingest."""
