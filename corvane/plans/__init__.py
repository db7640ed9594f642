"""Registered queries. Importing this package registers them all."""

from corvane.plans import analytics_queries, field_queries, record_queries, relational_queries, text_queries  # noqa: F401
