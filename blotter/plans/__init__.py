"""Mart plans: one DataFrame per result table, each a single job."""
