"""Training-data operators: deduplication, classifiers, tokenising, archives, extraction, search and sharding."""
