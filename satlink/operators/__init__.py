"""Operators: flatteners, filters, anti-joins, vault loaders, PIT, marts and checks."""
