"""Query plans: the ERA base relation and the registry of named queries."""
