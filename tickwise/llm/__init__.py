"""Training-data operators: packing, decontamination, sharding, extraction,
personal data, archives, URL filters, toxicity, quality rules, near copies."""
