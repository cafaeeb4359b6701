"""Training-data operators: mixing, sharding, decontamination, extraction, deduplication,
formatting, language identification and vector search. Nothing else in the library imports this package."""
