"""Registered queries by operator family."""

from orderloom.plans.queries import aggregates, feeds, merges, relational, text, warehouse  # noqa: F401
