"""Training-data operators: dedup, decontamination, mixing, classifiers, scans, chat formatting."""
