"""Operators that prepare text for training: filters, de-duplication, mixing, sharding and tokens."""
