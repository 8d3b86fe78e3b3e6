"""Training-data operators: decontamination, packing, deduplication, quality,
toxicity, chat formatting, personal data and secrets."""
