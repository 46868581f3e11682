"""Plans: feed normalisation, marts, activity analysis, table copy, the whole refresh."""
