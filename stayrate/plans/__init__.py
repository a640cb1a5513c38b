"""The staged job and the registry of runnable queries."""
