"""Training-data operators: packing, search, dedup, resampling, mixing, filters, scans, token files."""
