"""Composed reports (collect, clean, attainment, compare, movers), the query
catalog and its SQL oracle."""
