"""Relational building blocks: keep-latest, skew-safe joins, distributed ranks, constraints, loads."""
