"""Training-data operators: filters, near-duplicate removal, search, packing. Nothing outside this folder imports it."""
