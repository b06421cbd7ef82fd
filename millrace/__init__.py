"""Corpus preparation on Spark: scans, filters, splits, variants, balancing and pairing as DataFrame plans."""
