"""Training-data operators: extraction, dedup, scoring, mixing and search over text tables."""
