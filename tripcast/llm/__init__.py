"""Operators for large-scale training-data preparation (text, chat, packing, sharding)."""
