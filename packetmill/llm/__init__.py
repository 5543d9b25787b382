"""Training-data operators: formatting, packing, deduplication, filtering and span detection."""
