"""Registered queries: every operator on projections of the driver tables, next to its SQL."""
