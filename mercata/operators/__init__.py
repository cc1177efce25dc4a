"""Reusable DataFrame operators: keyed merges, global order, sampling, order-weighted metrics."""
