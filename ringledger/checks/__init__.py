"""Queries over the star-schema test tables, with their SQL twins."""
