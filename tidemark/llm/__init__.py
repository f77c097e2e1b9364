"""Training-data operators: near-duplicates, scans, scoring, packing and sharding."""
