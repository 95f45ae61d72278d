"""Shared DataFrame helpers: global order, exact selection, lookups, random columns."""
