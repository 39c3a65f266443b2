"""Text-corpus operators: language id, scoring, decontamination, sharding, PII, quality, packing, search, joins."""
