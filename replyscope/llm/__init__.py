"""Training-data operators: extraction, filters, packing, quality rules,
fingerprints, tokenizer work, deduplication and language-model scoring.

Nothing else in the library imports this subpackage."""
