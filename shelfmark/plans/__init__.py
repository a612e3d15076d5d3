"""Reports, load flows and the registry of runnable queries."""
