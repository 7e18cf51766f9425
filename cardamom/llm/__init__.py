"""Training-data operators: dedup, packing, search, archives, scoring, counting."""
