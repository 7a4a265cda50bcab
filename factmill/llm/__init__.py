"""Training-data operators: dedup, decontamination, classifiers, mixing and sharding."""
