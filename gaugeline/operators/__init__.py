"""Table operators: publishing, collecting, queue state, queries and table upgrades."""
