"""Operators for preparing training text: filters, near copies, repeats, mixing, rendering."""
