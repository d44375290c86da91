"""Training-data operators: packing, nearest neighbours, near-duplicates, sharding, toxicity,
fingerprints, license scans, line dedup, tokenization and language-model scores."""
