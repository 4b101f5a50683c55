"""Training-data operators: language, personal data, near duplicates, mixing, pages, quality, secrets, repeats, licences, benchmarks."""
