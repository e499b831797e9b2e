"""Plans: the multi-month run, the registered queries and their SQL oracles."""
