"""Composed plans: the query surface, SQL registration and the build."""
