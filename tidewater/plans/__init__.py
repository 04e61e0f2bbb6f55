"""Composed plans: the load pipeline, metrics, monitoring and query registry."""
