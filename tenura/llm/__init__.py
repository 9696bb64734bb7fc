"""Operators for building training corpora: extraction, filters, duplicates, decontamination, tokens, packing, archives."""
