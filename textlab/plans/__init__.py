"""Query plans: fixtures, the query registry and its oracle SQL, pipelines."""
