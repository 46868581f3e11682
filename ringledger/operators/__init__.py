"""Operators the plans are made of: staging, billing periods, row numbers."""
