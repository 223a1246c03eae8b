"""Registered queries over the test tables and their SQL oracles."""

from importlib import import_module

MODULES = (
    "points_queries",
    "stats_queries",
    "filters_queries",
    "joins_queries",
    "sampling_queries",
    "grid_queries",
    "models_queries",
    "sources_queries",
    "plans_queries",
)


def load() -> None:
    """Import every query module once; importing registers its queries."""
    for name in MODULES:
        import_module(f"heightgrid.catalog.{name}")
