"""Operators for preparing text corpora: deduplication, filters, token counts, packing."""
