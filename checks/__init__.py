"""Queries over the given tables: the engine's operators on stand-in observations, and their SQL."""
