"""Training-data operators: deduplication, decontamination, scans, classifiers, tokenising, sharding."""
