"""Readers: delimited files, workbook cells and sheet ranges, relational tables."""
