"""Reusable plan shapes and the registry of runnable queries with their SQL oracles."""
