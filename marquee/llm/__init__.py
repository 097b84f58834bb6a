"""Training-data operators: line dedup, quality scoring, WARC, fingerprints, tokenisation, near-duplicates,
HTML extraction, secret scans, exact vector search and source mixing. Nothing else in the library imports this."""
