"""Operators that prepare training text: filters, duplicates, mixing, sharding, rendering."""
