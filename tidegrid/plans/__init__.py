"""Operators put together: feature build, monitoring run and the query registry."""
