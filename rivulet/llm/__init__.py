"""Operators for preparing training text: sharding, language-model scoring,
fingerprints, exact / near / substring dedup, chat parsing, packing, byte-level
BPE and toxicity. Nothing else in the library imports this package."""
