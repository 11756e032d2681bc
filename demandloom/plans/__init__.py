"""The four plans: refresh, train, select, serve."""
