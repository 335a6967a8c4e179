"""Registered queries over the driver tables, each next to its SQL oracle."""

from __future__ import annotations

from lakestrata.queries.registry import REGISTRY


def load_all() -> dict:
    """Import every query module, which fills the registry."""
    from lakestrata.queries import frames, learning, reshaping, scalars, storage, tables  # noqa: F401

    return REGISTRY
