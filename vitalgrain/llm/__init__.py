"""Training-data operators: tokens, packing, fingerprints, language, deduplication, sharding, scoring, archives."""
