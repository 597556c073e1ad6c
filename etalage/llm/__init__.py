"""Operators that prepare training data: token counts, filters, de-duplication, packing, sharding, archives."""
