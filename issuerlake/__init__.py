"""Spark jobs for Brazilian corporate-credit data: every issuer in one pass."""
