"""Plans: the daily jobs and the registered queries with their SQL twins."""
