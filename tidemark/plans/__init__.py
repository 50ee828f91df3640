"""Query plans over the test tables: feeds, the registry and the oracle SQL."""
