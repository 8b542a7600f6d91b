"""Reusable DataFrame operators: skew handling, top-N, pair kernels, copy groups."""
