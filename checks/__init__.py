"""Driver queries over the test tables, each beside its oracle SQL."""
