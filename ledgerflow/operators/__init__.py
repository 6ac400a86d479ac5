"""DataFrame-to-DataFrame operators: validation, duplicates, merge, gold, quality, profile."""
