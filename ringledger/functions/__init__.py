"""Column expressions shared by the feeds: text pieces, dates and periods, lenient casts."""
