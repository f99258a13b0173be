"""Training-data operators: archives, filters, dedup, decontamination, packing."""
