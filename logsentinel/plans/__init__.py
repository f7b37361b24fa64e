"""Registered plans: the query catalog and its SQL oracles."""
